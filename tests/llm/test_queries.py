"""Every query over the smallest data: against its SQL, or against a brute-force version."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from stratiform.llm import ORACLES, QUERIES, syncmers

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall())


def test_all_are_registered():
    known = entry_module.queries()
    assert set(QUERIES) | {"pipeline"} <= set(known)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(llm, name):
    assert compare(QUERIES[name](llm, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


def test_packing_has_all_tokens_in_full_sequences(llm, docs):
    rows = QUERIES["op3_best_two_fit_packing"](llm, SF_DIR).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.start for r in own] == [sum(x.length for x in own[:n]) for n in range(len(own))]
        assert sum(r.length for r in own) == len(ids) and all(r.length == 2048 for r in own[1:])
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:n]) for n in range(len(own))]
        assert sum(r.length for r in own) <= 2048
    assert len(by_sequence) <= math.ceil(sum(r.length for r in rows) / 2048) + 1


def test_toxicity_holds_out_its_fold(llm):
    rows = QUERIES["op5_deobfuscated_toxicity"](llm, "/root/testdata/sf0.01").collect()
    truth = dict(duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.9


def _marks(text, k=12, s=4):
    def hashed(part):
        h = xxhash.xxh64_intdigest(part, 42)
        return h - (1 << 64) if h >> 63 else h

    data = re.sub(r"[ \t-\r]+", " ", text or "").strip(" ").encode()
    if len(data) < k:
        return [hashed(data) >> 32 & 0xFFFFFFFF] if data else []
    runs = [hashed(data[i : i + s]) for i in range(len(data) - s + 1)]
    width = k - s + 1
    closed = [i for i in range(len(data) - k + 1) if min(runs[i : i + width]) in (runs[i], runs[i + width - 1])]
    return [hashed(data[i : i + k]) >> 32 & 0xFFFFFFFF for i in closed]


def test_fingerprints_are_those_of_brute_force(llm, docs):
    rows = {r.doc_id: r for r in QUERIES["op7_closed_syncmers"](llm, SF_DIR).collect()}
    ids = sorted(docs)
    like = lambda a, b: 1.0 if not a | b else 2 * len(a & b) / (len(a) + len(b))
    for i, j in zip(ids, ids[1:] + ids[:1]):
        text, half = docs[i], len(docs[i]) // 2
        edited = text[: len(text) - half] + docs[j][:half]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{m:08x}" for m in _marks(text))
        assert r.edited_fingerprint == "".join(f"{m:08x}" for m in _marks(edited))
        assert r.near_edited == pytest.approx(like(set(_marks(text)), set(_marks(edited))))
        assert r.near_next == pytest.approx(like(set(_marks(text)), set(_marks(docs[j]))))


def test_half_edited_texts_are_nearer_than_the_next(llm):
    """Texts of 40 characters and more, with and without spaces, in several scripts."""
    rows = QUERIES["op7_closed_syncmers"](llm, "/root/testdata/sf0.01").where("n_chars >= 40").collect()
    assert np.mean([r.near_edited > r.near_next or r.near_next == 1 for r in rows]) > 0.99
    unspaced = ["".join(chr(0x4E00 + (n * n * 31 + m * 977 + n * m * 7) % 5000) for n in range(40 + m)) for m in range(40)]
    unspaced += ["".join(chr(97 + (n * n * 3 + m * 5 + n // 7 * m) % 26) for n in range(40 + m)) for m in range(40)]
    pairs = llm.createDataFrame(list(zip(unspaced, unspaced[1:] + unspaced[:1])), "text string, next string")
    edited = pairs.withColumn("edited", syncmers.half_edited(F.col("text"), F.col("next")))
    marks = {c: syncmers.anchors(F.col(c)) for c in ("text", "next", "edited")}
    near = edited.select(syncmers.likeness(marks["text"], marks["edited"]).alias("edited"), syncmers.likeness(marks["text"], marks["next"]).alias("next")).collect()
    assert all(r.edited > r.next for r in near)


def test_blocks_of_a_long_text_join(llm):
    text = "".join(f"{n * n % 9973}-{n}" for n in range(8000))
    assert len(text) > 4 * syncmers.BLOCK
    found = llm.createDataFrame([(text,)], "text string").select(syncmers.written(syncmers.anchors(F.col("text")))).first()[0]
    assert found == "".join(f"{m:08x}" for m in _marks(text))


def test_anchors_of_joined_parts(llm):
    """Parts that are empty, white space, shorter than a k-mer, or cut at white space."""
    texts = ["", " ", "\t \n", "a", " abc", "abc ", "abcdefghijk", "abcdefghijkl", "  two words and some more \n", "日本語の文章はここに書きます", "one two three four five six", "x" * 40]
    rows = llm.createDataFrame([(t, t[:n], u, u[:m]) for t in texts for u in texts for n in (0, 5, 12, 99) for m in (0, 6, 13, 99)], "a string, head string, b string, tail string")
    joined = syncmers.joined_anchors(F.col("head"), syncmers.placed(F.col("a")), F.col("tail"), syncmers.placed(F.col("b")))
    for r in rows.select("head", "tail", syncmers.written(joined).alias("found")).collect():
        assert r.found == "".join(f"{m:08x}" for m in _marks(r.head + r.tail)), (r.head, r.tail)


def test_token_counts_are_those_of_the_library(llm, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in QUERIES["op10_transducer_token_counts"](llm, SF_DIR).collect():
        n = len(library.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def test_training_order_has_each_sequence_once(llm, docs):
    rows = QUERIES["op6_training_order"](llm, SF_DIR).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert {r.doc_id for r in rows} == set(docs)
