"""License scans, vector codes and fill-in-middle: brute force, round trips and awkward tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import CLASHING, EXTRA, TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from stratiform.llm import QUERIES, fim, gnat, licenses

SF_DIR = "/root/testdata/sf0.001"


# --- licenses ---


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_scan(texts, notices=licenses.TEMPLATES, base=licenses.BASE):
    """(n_words, places) of each text by looking at every start; places as (start, label, base, share)."""
    listed = [plain_words(t) for t in texts]
    known = [(label, plain_words(phrase), [(0, plain_words(phrase))], True) for phrase, label in base.items()]
    for label, notice in notices:
        words, phrases = [], []
        for n, part in enumerate(notice.replace("]", "[").split("[")):
            if n % 2:
                phrases.append((len(words), part.split()))
            words += part.split()
        known.append((label, words, phrases, False))
    df = Counter(w for words in listed for w in set(words))
    idf = lambda w: math.log((len(texts) + 1) / (df[w] + 1))
    out = []
    for words in listed:
        places = []
        for label, own, phrases, is_base in known:
            (first, head), *rest = phrases
            for s in range(len(words)):
                if words[s : s + len(head)] != head:
                    continue
                if any(all(words[p : p + len(ph)] != ph for p in range(max(0, s + q - first - 12), s + q - first + 13)) for q, ph in rest):
                    continue
                begin = s - first
                good = [w in words[max(0, begin + q - 3) : max(0, begin + q + 4)] for q, w in enumerate(own)]
                total = sum(map(idf, own))
                places.append((s, label, is_base, sum(idf(w) for w, g in zip(own, good) if g) / total if total else sum(good) / len(good)))
        out.append((len(words), places))
    return out


def as_row(n_words, places):
    base = [p for p in places if p[2]]
    starts = [p[0] for p in base]
    return (
        n_words, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({p[1] for p in base})),
        ",".join(sorted({p[1] for p in places})), pytest.approx(max((p[3] for p in places), default=0.0)),
    )


def test_licenses_are_those_of_brute_force(llm):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall())
    want = {i: as_row(*found) for i, found in zip(docs, plain_scan(docs.values()))}
    rows = QUERIES["op11_rare_word_licenses"](llm, SF_DIR).collect()
    assert len(rows) == len(docs) and {r.doc_id: tuple(r)[1:] for r in rows} == want
    assert {"apache-2.0", "cc-by,cc-by-nc", "mit", "reserved"} <= {r.labels for r in rows}


NOTICES = [
    "All rights reserved. ALL-RIGHTS/RESERVED all rights reservedé all rights", "cc by cc by-nc 4.0 cc, by", "the general public\nlicense; gnu general public license version 3 and general public license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "Permission is hereby granted for money", "licensed under the Apache License, ... filler " + "x " * 30 + "Apache License, Version 2.0",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Licensed under the Apache License by us and them, you, so that all of you may not use this file except in compliance with the License.",
    "Licensed under the Apache License " + "far " * 40 + "may not use this file except in compliance with the License.", "reserved rights all", "", None, " \t", "Copyright (c) 2020", "all rights " * 500 + "reserved", "cc by " * 3000,
]


def test_licenses_of_awkward_texts(llm):
    docs = llm.createDataFrame([(n, t, *EXTRA) for n, t in enumerate(NOTICES)] + [(0, NOTICES[0], *EXTRA)], "doc_id int, text string, " + ", ".join(f"`{c}` string" for c in [*CLASHING.split(), "a b.c"]))
    texts = [*NOTICES, NOTICES[0]]
    want = Counter((n % len(NOTICES), w, tuple(sorted((s, lab, b, round(x, 9)) for s, lab, b, x in p))) for n, (w, p) in enumerate(plain_scan(texts)))
    rows = licenses.scanned(docs, licenses.index(docs)).collect()
    assert Counter((r.row.doc_id, r.n_words, tuple(sorted((p.start, p.label, p.base, round(p.share, 9)) for p in r.places))) for r in rows) == want
    assert set(rows[0].row.asDict()) == {"doc_id", *CLASHING.split(), "a b.c"}


def test_licenses_of_tables_with_nulls_and_without_rows(awkward, empty):
    assert licenses.scanned(awkward, licenses.index(awkward)).count() == len(TEXTS)
    assert licenses.scanned(empty, licenses.index(empty)).collect() == []


def test_own_templates(llm):
    own = licenses.templates({"x y": "base"}, [("mine", "a [b c] d [e]")])
    docs = llm.createDataFrame([(1, "a b c d e x y"), (2, "b c e"), (3, "b c")], "doc_id int, text string")
    rows = {r.row.doc_id: [(p.label, p.start) for p in r.places] for r in licenses.scanned(docs, licenses.index(docs, known=own)).collect()}
    assert rows == {1: [("mine", 1), ("base", 5)], 2: [("mine", 0)], 3: []}
    with pytest.raises(ValueError):
        licenses.Template.of("none", "no phrase")


# --- vector codes ---


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 64), st.integers(1, 6), st.sampled_from([0, 1, 3, 50, 10**6, gnat.LARGEST]))
def test_nearest_entries_are_those_of_brute_force(seed, n, width, size):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-size, size + 1, (n, width))
    queries = np.concatenate((rng.integers(-size, size + 1, (200, width)), entries))
    at, squared = gnat.Search(entries).nearest(queries)
    whole = ((queries[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(2).astype(np.int64)
    assert (at == whole.argmin(1)).all() and (squared == whole.min(1)).all()


def test_whole_subtrees_are_left_out():
    rng = np.random.default_rng(3)
    search = gnat.Search(rng.integers(-60, 60, (256, 4)))
    search.nearest(rng.integers(-60, 60, (2000, 4)))
    assert search.measured < 2000 * 256 / 3


def plain_codes(rows, parts, entries, rounds):
    """(code, error) by comparing every part with every entry; rows of (id, integers), in the order of the ids."""
    cut = [[v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)] for v in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, q):
        return min((sum((a - b) ** 2 for a, b in zip(q, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        owned = defaultdict(list)
        for c in cut:
            for p, q in enumerate(c):
                owned[p, near(p, q)[1]].append(q)
        for (p, i), qs in owned.items():
            books[p][i] = [sum(x) // len(qs) for x in zip(*qs)]
    found = [[near(p, q) for p, q in enumerate(c)] for c in cut]
    return [("".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for f in found], books


def test_codes_of_awkward_vectors(llm):
    rng = np.random.default_rng(5)
    good = [[float(x) for x in v] for v in rng.normal(size=(40, 8))]
    rows = [(n, v, n % 3 or None, *EXTRA) for n, v in enumerate(good)]
    rows += [(3, good[3], 1, *EXTRA), (3, good[3], 1, *EXTRA), (None, good[1], 2, *EXTRA), (50, [1e30, *good[0][1:]], 2, *EXTRA)]
    bad = [(-1, None), (-2, []), (-3, [1.0, None, *good[0][2:]]), (-4, [float("nan"), *good[0][1:]]), (-5, [float("-inf"), *good[0][1:]]), (60, [1.0] * 4), (61, [1.0] * 12)]
    table = llm.createDataFrame(rows + [(i, v, 1, *EXTRA) for i, v in bad], "vec_id int, embedding array<double>, label int, " + ", ".join(f"`{c}` string" for c in [*CLASHING.split(), "a b.c"]))
    codes, books = gnat.quantised(table.repartition(5), parts=4, entries=16)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(max(min(x * 256, 2.0**26), -(2.0**26))) for x in r[1]] for r in ordered]
    want, plain_books = plain_codes(whole, 4, 16, 2)
    assert books.entries.tolist() == plain_books
    assert Counter((r.row.vec_id, r.code, r.error) for r in codes.collect()) == Counter((r[0], *w) for r, w in zip(ordered, want))
    errors = defaultdict(int)
    for r, (_, e) in zip(ordered, want):
        errors[r[2]] += e
    found = gnat.by_label(codes, "label").collect()
    assert len(found) == len(rows) and all(r.label_error == errors[r.row.label] for r in found)
    assert set(found[0].row.asDict()) == {"vec_id", "label", *CLASHING.split(), "a b.c"}


def test_codes_of_few_equal_and_no_vectors(llm):
    same = llm.createDataFrame([(n, [1.0, 2.0], None) for n in range(5)], "vec_id int, embedding array<float>, label int")
    codes, books = gnat.quantised(same, parts=2, entries=3)
    assert {(r.code, r.error) for r in codes.collect()} == {("0000", 0)} and books.entries.shape == (2, 3, 1)
    for none in (same.where("false"), llm.createDataFrame([(1, [1.0] * 3, 1)], same.schema)):
        codes, books = gnat.quantised(none, parts=2)
        assert codes.collect() == [] and books is None and gnat.by_label(codes, "label").collect() == []
    with pytest.raises(ValueError):
        gnat.quantised(same, entries=257)


# --- fill in the middle ---


@settings(max_examples=200, deadline=None)
@given(st.text("ab<PSM>\nqé日\U0001f600\r\x0b", max_size=60), st.text("0123456789", max_size=4))
def test_every_document_comes_back(text, key):
    done = fim.transform(text.encode(), key)
    output = done.table.bytes()
    assert fim.restored(output, done.form).bytes() == text.encode()
    assert done.table.digest() == hashlib.sha256(output).hexdigest()
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert done.n == len(lines)
    h = [int(hashlib.sha256(f"7:{key}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text:
        assert (done.form, output.decode(), done.prefix_chars) == ("plain", text, None)
    else:
        assert (done.form, done.prefix_chars, done.middle_chars) == ("spm" if h[3] % 100 < 50 else "psm", len(p), len(m))
        assert output.decode() == (f"<S>{s}<P>{p}<M>{m}" if done.form == "spm" else f"<P>{p}<S>{s}<M>{m}")


@given(st.lists(st.integers(0, 20), max_size=5), st.permutations(range(4)))
def test_cuts_of_cut_tables(at, order):
    text = bytes(range(20))
    quarters = fim.PieceTable.of(text).cut([5, 10, 15])
    table = fim.PieceTable(quarters[0].text, tuple(p for n in order for p in quarters[n].pieces))
    parts = table.cut(sorted(at))
    assert len(parts) == len(at) + 1 and b"".join(p.bytes() for p in parts) == table.bytes()
    assert [len(p.bytes()) for p in parts] == list(np.diff([0, *sorted(at), 20]))


def test_middle_of_awkward_tables(llm, awkward, empty):
    found = fim.transformed(awkward, with_output=True)
    back = fim.restored_texts(found).collect()
    assert Counter((r.row.doc_id, r.restored) for r in back) == Counter((i, t or "") for i, t in TEXTS)
    for r in back:
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() and r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
        assert r.form != "plain" or r.restored == r.output
    assert {r.form for r in back if r.restored == ""} == {"plain"}
    assert set(back[0].row.asDict()) == set(awkward.columns) - {"text"}
    assert fim.transformed(empty).collect() == []


def test_choices_and_lost_sentinels(llm):
    docs = llm.createDataFrame([(n, f"{n}\nb\nc\n") for n in range(200)], "doc_id int, text string")
    forms = Counter(r.form for r in fim.transformed(docs, choice=fim.Choice(seed=1, percent=50, suffix_first=0)).collect())
    assert set(forms) == {"plain", "psm"} and 60 < forms["psm"] < 140
    odd = llm.createDataFrame([("no marks", "psm"), (None, "spm"), ("text", "other"), ("text", None), ("text", "plain")], "output string, form string")
    assert [r.restored for r in fim.restored_texts(odd).collect()] == [None, None, None, None, "text"]
