"""NULLs, empty and very long texts, ties, repeated rows, clashing names and empty tables, for every operator and stage."""

import gzip
import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import TEXTS
from pyspark.sql import functions as F

import corpus_pipeline
from stratiform.llm import exact, minhash, mixing, order, packing, substrings, syncmers, tokencount, toxicity, warc
from stratiform.llm.encoding import BYTE_BPE, encode
from stratiform.llm.transducer import transducer


def squeezed(text):
    return re.sub(r"[ \t-\r]+", " ", text or "")


def test_exact_dedup_keeps_one_row_of_each_text(awkward):
    kept = exact.unique(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    assert Counter(squeezed(r.text) for r in rows) == Counter({squeezed(t) for _, t in TEXTS})
    first = {}
    for i, t in TEXTS:
        first[squeezed(t)] = min(first.get(squeezed(t), (True, 0)), (i is None, i or 0))
    assert all((r.doc_id is None, r.doc_id or 0) == first[squeezed(r.text)] for r in rows)


def test_index_lasts_and_takes_new_digests_only(llm):
    index = exact.new_index(llm)
    one = exact.stage(llm.createDataFrame([(5, "a"), (6, "b")], "doc_id bigint, text string"))
    two = exact.stage(llm.createDataFrame([(1, "a"), (2, "c"), (2, "c")], "doc_id bigint, text string"))
    for staged in (one, two, one, two):
        index.append(staged)
    assert index.read().count() == 3
    rows = {(r.key, r.keep_key, r.group_size, r.kept) for r in exact.decide(index, two).collect()}
    assert rows == {(1, 5, 1, False), (2, 2, 2, True), (2, 2, 2, False)}
    plan = exact.decide(index, two)._jdf.queryExecution().toString()
    assert "digest_index" not in plan  # groups were written
    files = index.read().select(F.input_file_name()).distinct().count()
    assert files <= 3 and "Bucket" in "".join(r.col_name for r in llm.sql(f"DESCRIBE EXTENDED {index.name}").collect())


def test_near_duplicates(awkward):
    rows = minhash.near_duplicates(awkward, words=4).collect()
    assert len(rows) == len(TEXTS)
    found = defaultdict(set)
    for r in rows:
        found[r.key].add((r.n_shingles, r.component_id))
    assert found[2] == {(6, 1)} and found[3] == {(6, 1)} and found[4] == {(0, 4)} and found[6] == {(0, 6)}
    assert {c for _, c in found[8]} == {7} and {c for _, c in found[11]} == {10} and {c for _, c in found[12]} == {12} and found[9] == {(1, 9)} and found[14] == {(1, 14)}
    kept = minhash.deduplicated(awkward, words=4)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 5, 6, None, None, 7, 9, 10, 12, 12, 13, 14])


def test_near_duplicates_of_a_large_bucket_are_those_of_brute_force(llm, monkeypatch):
    """A group of near copies, no member of which is linked with all others, in small blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = [f"w{n}" for n in range(160)]
    texts = []
    for n in range(120):
        own = list(base)
        for at in rng.choice(160, rng.integers(1, 9), replace=False):
            own[at] = f"e{n}x{at}"
        texts.append((n, " ".join(own)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert 1 < len(set(label)) < len(texts)
    found = {r.key: r.component_id for r in minhash.near_duplicates(llm.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert [found[n] for n in range(len(texts))] == label


def test_packing(awkward):
    placed = packing.packed(awkward, with_ids=True)
    rows = placed.collect()
    assert sum(r.length for r in rows) == sum(len(encode(t or "", BYTE_BPE)) + 1 for _, t in TEXTS)
    whole = {r.sequence_id: r for r in packing.sequences(placed).collect()}
    for r in rows:
        ids = whole[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)]
        assert zlib.crc32(bytes(ids)) == r.ids_crc32 and bytes(ids) == bytes(r.ids)
    assert all(len(s.ids) == 4 * s.length <= 4 * 2048 for s in whole.values())


def test_packed_sequences_follow_the_mixture(llm, tmp_path):
    """Nine tenths of the text in one source: the target is 3 to 1, and sequences of any prefix have that until the small source runs out."""
    texts = [(n, "big" if n % 10 else "small", " ".join(f"w{n * 31 % 977}x{i * n % 89}" for i in range(200 + n * 37 % 500))) for n in range(1500)]
    llm.createDataFrame(texts, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/docs")
    docs = llm.read.parquet(f"{tmp_path}/docs")
    small = {n for n, s, _ in texts if s == "small"}
    stages = dict(corpus_pipeline.STAGES)
    whole = stages["packing"](llm, stages["mixing"](llm, docs, ""), "")
    for placed in (whole, packing.packed_mixture(docs, block_chars=10_000, stretch=40_000)):
        rows = placed.collect()
        by_sequence = defaultdict(list)
        for r in rows:
            by_sequence[r.sequence_id].append(r)
        assert sum(r.length for r in rows) == sum(len(encode(t, BYTE_BPE)) + 1 for *_, t in texts)
        assert sorted(by_sequence) == list(range(len(by_sequence)))
        for own in by_sequence.values():
            own.sort(key=lambda r: r.offset)
            assert [r.offset for r in own] == [sum(x.length for x in own[:n]) for n in range(len(own))] and sum(r.length for r in own) <= 2048
        for part in (0.15, 0.25, 0.35):
            prefix = [r for r in rows if r.sequence_id < part * len(by_sequence)]
            share = sum(r.length for r in prefix if r.doc_id in small) / sum(r.length for r in prefix)
            assert abs(share - 0.25) < 0.06


def test_substrings(awkward):
    rows = substrings.cleaned(awkward, window=35).collect()
    assert len(rows) == len(TEXTS)
    by_text = {(r.row.doc_id, r.n_words): r for r in rows}
    assert by_text[10, 63].kept_text == "before it after" and by_text[11, 64].kept_text == "something else and more"
    assert [(s.start, s.end) for s in by_text[10, 63].removed] == [(2, 62)]
    assert by_text[7, 12000].n_removed == 12000 and by_text[8, 12001].kept_text == "end"
    assert by_text[14, 300].n_removed == 300 and by_text[4, 0].kept_text == "" and by_text[3, 9].n_removed == 0
    once = substrings.cleaned(awkward.where("doc_id = 3"), window=9).select("n_words", "n_removed").distinct().collect()
    assert [tuple(r) for r in once] == [(9, 9)]


def test_hot_buckets_of_windows_count_the_same(llm, monkeypatch):
    texts = [(n, f"a{n} b{n} " + " ".join(f"p{i}" for i in range(12)) + f" c{n}") for n in range(40)]
    docs = llm.createDataFrame(texts, "doc_id bigint, text string")
    plain = {tuple(r) for r in substrings.cleaned(docs, window=8, minimiser=3).select("row.doc_id", "kept_text").collect()}
    monkeypatch.setattr(substrings, "HOT", 5)
    assert {tuple(r) for r in substrings.cleaned(docs, window=8, minimiser=3).select("row.doc_id", "kept_text").collect()} == plain
    assert plain == {(n, f"a{n} b{n} c{n}") for n in range(40)}


def test_fingerprints(awkward):
    rows = syncmers.with_next(awkward).collect()
    assert len(rows) == len(TEXTS)
    ordered = sorted(((i is None, i or 0, hashlib.md5((t or "").encode()).hexdigest()), t or "") for i, t in TEXTS)
    want = Counter((t, u) for (_, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1]))
    assert Counter((r.text, r.next_text) for r in rows) == want
    marks = {r.text: r.found for r in rows}
    assert marks[""] == [] and marks[" \n\t "] == [] and len(marks["short"]) == 1
    assert marks[TEXTS[0][1]] == marks[TEXTS[1][1]] != []
    assert all(r.next_found == marks[r.next_text] for r in rows)


def test_token_counts(awkward):
    rows = tokencount.token_counts(awkward, chunk=1000).collect()
    machine = transducer(tokencount.PIECE_BPE)
    want = Counter((i, len((t or "").encode()), machine.count(t or "")) for i, t in TEXTS)
    assert Counter((r.row.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
    assert "a b.c" in rows[0].row.asDict() and "text" not in rows[0].row.asDict()


def test_toxicity(awkward, labels):
    model = toxicity.fit(awkward, labels)
    rows = toxicity.scored(awkward, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    scores = defaultdict(set)
    for r in rows:
        scores[r.row.text or ""].add(r.score)
    assert all(len(s) == 1 for s in scores.values())
    nothing = toxicity.fit(awkward, labels.where("toxic = 2"))
    assert {r.score for r in toxicity.scored(awkward, nothing).collect()} == {0.0}


@pytest.mark.parametrize("toxic_of_ten", [1, 3, 5, 7, 9])
def test_toxicity_learns_at_any_balance(llm, toxic_of_ten):
    """Words that say one label or the other, with one row in ten of the other kind."""
    words = {True: "moron", False: "lovely"}
    rows = [(n, f"the {words[(n % 10 < toxic_of_ten) != (n // 10 % 10 == 9)]} thing of {n}", int(n % 10 < toxic_of_ten)) for n in range(400)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert model.weights["moron$"] > 0 > model.weights["lovely$"]
    decoder = toxicity.Decoder(model.cost)
    assert model.score(decoder, "a moron") > 0.5 > model.score(decoder, "a lovely one")


def test_mixing(awkward):
    placed = mixing.schedule(awkward, block_chars=50).collect()
    assert Counter((r.row.doc_id, r.row.text) for r in placed) == Counter(TEXTS)
    assert all(r.release <= r.slot < r.due and r.block == r.start // 50 for r in placed)
    assert mixing.mixed(awkward).columns == awkward.columns
    rows = [("a", 4.0), ("b", None), ("c", -1.0), ("d", float("inf")), ("e", float("nan")), ("f", 1.0), ("g", 1e-30)]
    units = {r.source: r.units for r in mixing.whole_weights(awkward.sparkSession.createDataFrame(rows, "source string, weight double")).collect()}
    assert units == {"a": 1 << 40, "f": 1 << 38, "g": 1, **dict.fromkeys("bcde", 1 << 34)}
    none = mixing.whole_weights(awkward.sparkSession.createDataFrame([("a", None), ("b", 0.0)], "source string, weight double")).collect()
    assert len({r.units for r in none}) == 1


def queue(sources):
    """Earliest deadline first over (source, weight, blocks), one slot after the other from two heaps."""
    top = max(w for _, w, _ in sources)
    units = {s: max(1, math.floor(w / top * 2**40)) for s, w, _ in sources}
    blocks = {s: n for s, _, n in sources}
    total = sum(units[s] for s, n in blocks.items() if n)
    waiting, ready, slot, out = sorted((0, s, 0) for s, n in blocks.items() if n), [], 0, []
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // units[s]), s, j, release))
        due, s, j, release = heapq.heappop(ready)
        out.append((s, j, slot, release, due, len(out)))
        slot += 1
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, ((j + 1) * total // units[s], s, j + 1))
    return out


@pytest.mark.parametrize(("seed", "n", "slots"), [(1, 1, 3), (2, 2, 1), (3, 7, 8), (4, 20, 16), (5, 60, 5), (6, 60, 64)])
def test_ranges_of_time_give_what_one_queue_gives(llm, seed, n, slots):
    """Ranges scheduled apart, with sources that run out, idle slots and blocks that wait over many borders."""
    rng = random.Random(seed)
    sources = [(f"s{i}", rng.choice([1.0, rng.random() * 10, 0.01, rng.random()]), rng.choice([0, 1, 5, 40, 150])) for i in range(n)] + [("z", 2.0, 90)]
    rows = mixing.turn_table(llm.createDataFrame(sources, "source string, weight double, blocks bigint"), slots).collect()
    assert sorted(map(tuple, rows)) == sorted(queue(sources))


def test_mixing_meets_its_targets_in_every_prefix(llm):
    docs = llm.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'big' ELSE concat('s', id % 4) END AS source", "repeat('x', 9) AS text")
    share = {"big": 0.437, "s0": 0.2, "s1": 0.011, "s2": 0.1, "s3": 0.252}  # no whole shares of 64
    rows = mixing.schedule(docs, llm.createDataFrame(list(share.items()), "source string, weight double"), block_chars=100).groupBy("slot", "source_name").count().orderBy("slot").collect()
    assert len({r.slot for r in rows}) == len(rows)  # one block at a time
    had, slot = Counter(), 0
    for r in rows:
        assert r.slot == slot  # until a source runs out
        had[r.source_name] += 1
        slot += 1
        assert all(abs(had[s] - slot * w) < 1 + 1e-9 for s, w in share.items())
        if slot == 150:
            break


def test_mixing_keeps_targets_that_no_share_divides(llm):
    """Weights as they are: a hot source, one of 1.99/64 of it, a tiny one, and many more; within a block of the target in every prefix, over several ranges."""
    weights = {"hot": 1.0, "odd": 1.99 / 64, "tiny": 1e-5, **{f"s{n}": 2e-3 for n in range(300)}}
    total = sum(weights.values())
    blocks = [(s, w, 2 + int(9000 * w / total)) for s, w in weights.items()]
    rows = mixing.turn_table(llm.createDataFrame(blocks, "source string, weight double, blocks bigint")).where("slot < 9000").orderBy("slot").collect()
    had = Counter()
    for n, r in enumerate(rows):
        assert r.slot == r.turn == n and r.release <= n < r.due and r.block == had[r.source_name]
        had[r.source_name] += 1
        if n % 500 == 0:
            assert all(abs(had[s] - (n + 1) * w / total) < 1 + 1e-6 for s, w in weights.items())
    assert len(rows) == 9000


def test_twenty_thousand_sources_are_mixed(llm):
    sources = llm.range(20_000).selectExpr("concat('s', id) AS source", "1.0D + id % 3 AS weight", "1L + id % 2 AS blocks")
    rows = mixing.turn_table(sources).collect()
    assert len(rows) == 30_000 == len({r.slot for r in rows}) and all(r.release <= r.slot < r.due for r in rows)


def test_leaving_the_mixture_out_or_changing_it_changes_the_sequences(llm, tmp_path):
    """Packing follows the files that the mixing stage wrote, and other targets give other sequences."""
    texts = [(n, "big" if n % 5 else "small", " ".join(f"w{n * 31 % 977}x{i * n % 89}" for i in range(100 + n * 37 % 900))) for n in range(400)]
    llm.createDataFrame(texts, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/docs")
    docs, stages = llm.read.parquet(f"{tmp_path}/docs"), dict(corpus_pipeline.STAGES)
    targets = llm.createDataFrame([("big", 1.0), ("small", 9.0)], "source string, weight double")
    found = {}
    for name, ordered in (("mixed", stages["mixing"](llm, docs, "")), ("other", mixing.mixed(docs, targets)), ("none", docs)):
        ordered.write.parquet(f"{tmp_path}/{name}")
        written = llm.read.parquet(f"{tmp_path}/{name}")
        found[name] = {(r.doc_id, r.piece): r.sequence_id for r in stages["packing"](llm, written, "").collect()}
        close = packing.packed_in_order(packing.in_file_order(written), stretch=40_000).where("sequence_id < 150 AND doc_id % 5 = 0")
        found[f"small in {name}"] = close.agg(F.sum("length")).first()[0]
    assert found["mixed"] != found["none"] and found["mixed"] != found["other"]
    assert found["small in other"] > 1.3 * found["small in mixed"] and found["small in mixed"] > 1.2 * found["small in none"]


def test_sequences_follow_the_rows_of_the_files(llm, tmp_path):
    """Files are cut for reading; rows keep their places, files go by number and not by name."""
    rows = llm.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 30) AS text")
    rows.where("doc_id < 2000").write.parquet(f"{tmp_path}/a")
    rows.where("doc_id >= 2000").write.parquet(f"{tmp_path}/b")
    (tmp_path / "all").mkdir()
    for folder_, number in (("a", "99999"), ("b", "100000")):
        file = next((tmp_path / folder_).glob("*.parquet"))
        (tmp_path / "all" / f"part-{number}-x.parquet").write_bytes(file.read_bytes())
    placed = packing.in_file_order(llm.read.parquet(f"{tmp_path}/all")).orderBy("part", "group", "place").select("doc_id").collect()
    assert [r.doc_id for r in placed] == list(range(3000))
    by_sequence = packing.packed_in_order(packing.in_file_order(llm.read.parquet(f"{tmp_path}/all")), stretch=4096).groupBy("sequence_id").agg(F.min("doc_id"), F.max("doc_id")).orderBy("sequence_id").collect()
    assert all(a[1] < b[2] and b[2] - b[1] < 200 for a, b in zip(by_sequence, by_sequence[1:]))


def test_training_order(awkward, folder):
    manifest = order.materialise(awkward, f"{folder}/order", length=64, shard=100).collect()
    lengths = Counter()
    for r in manifest:
        lengths[r.doc_id] += r.n_tokens
    want = Counter()
    for i, t in TEXTS:
        want[i] += len(encode(t or "", BYTE_BPE)) + 1
    assert lengths == want and sorted(r.slot for r in manifest) == list(range(len(manifest)))
    by_slot = {r.slot: r for r in manifest}
    read = order.read_from(awkward.sparkSession, f"{folder}/order", 130, length=64, shard=100).collect()
    assert sorted(r.slot for r in read) == list(range(130, len(manifest)))
    for r in read:
        known = by_slot[r.slot]
        assert len(r.ids) == 128 and zlib.crc32(bytes(r.ids)[: 2 * known.n_tokens]) == known.ids_crc32
        assert (known.shard, known.offset) == (r.slot // 100, r.slot % 100 * 129)
    other = order.materialise(awkward, f"{folder}/other", length=64, shard=100, seed="b").collect()
    assert {(r.doc_id, r.piece, r.ids_crc32, r.slot) for r in other} != {(r.doc_id, r.piece, r.ids_crc32, r.slot) for r in manifest}


PAGES = [
    (1, "http://a/", "<html lang=fr><head><title> A &amp;\n B</title></head><body><p>One <b>two</b><br>three&nbsp;&#8364;&#x1F600; &lt;x&gt; &amp;lt; &#55555;</p><script>no()</script><!-- no --></body>"),
    (2, None, None), (2, None, None), (None, "http://b/", ""), (3, "http://c/", "a < b and <broken"), (4, "http://d/", "<p>" + "long " * 50_000),
]


def test_warc(llm, folder):
    pages = llm.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id bigint, url string, html string, block string, record_id string")
    records = warc.derivatives(warc.responses(pages))
    rows = records.collect()
    assert len(rows) == 2 * len(PAGES)
    by = {(r.source_key, r.kind): r for r in rows}
    assert by[1, "conversion"].block == "One two\nthree €\U0001f600 <x> &lt; �"
    assert by[2, "conversion"].block == "" and by[3, "conversion"].block == "a < b and <broken" and len(by[4, "conversion"].block) == 249_999
    meta = by[1, "metadata"]
    assert "title: A & B\r\nlanguage: fr\r\n" in meta.block and "source-header: Content-Type: text/html; charset=utf-8\r\n" in meta.block
    assert f"conversion-record-id: {by[1, 'conversion'].record_id}\r\n" in meta.block and f"source-payload-digest: {meta.source_digest}\r\n" in meta.block
    assert meta.refers_to == by[1, "conversion"].refers_to and f"WARC-Concurrent-To: {by[1, 'conversion'].record_id}" in meta.headers
    assert "WARC-Target-URI" not in by[2, "metadata"].headers
    warc.write_warc(records, f"{folder}/warc")
    import glob

    read = []
    for path in glob.glob(f"{folder}/warc/*.gz"):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
            assert fields[b"WARC-Block-Digest"] == b"sha256:" + hashlib.sha256(rest[:n]).hexdigest().encode()
            read.append((fields[b"WARC-Record-ID"].decode(), rest[:n].decode()))
            data = rest[n + 4 :]
    assert Counter(read) == Counter((r.record_id, r.block) for r in rows)


def test_warc_decodes_every_character_reference(llm):
    html = "<p>caf&eacute; &uuml;&szlig;&ntilde;&shy;&times; &#x0001F600; &#0000000233; &amp;eacute; &#38;#233; &NotEqualTilde; a&b &nosuch; &#99999999999; &eacute &#128;</p>"
    rows = warc.derivatives(warc.responses(llm.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string"))).where("kind = 'conversion'").collect()
    assert rows[0].block == "café üßñ\u00ad× \U0001f600 é &eacute; &#233; ≂̸ a&b &nosuch; \ufffd é €"
    assert rows[0].block_digest == "sha256:" + hashlib.sha256(rows[0].block.encode()).hexdigest()
    import html as markup

    assert all(warc.unescaped(f"&{name}") == value for name, value in markup.entities.html5.items() if name != "nbsp;")


def test_empty_tables(llm, empty, labels, folder):
    assert exact.unique(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == minhash.deduplicated(empty).count() == 0
    assert packing.packed(empty).count() == substrings.cleaned(empty).count() == tokencount.token_counts(empty).count() == 0
    assert syncmers.with_next(empty).count() == mixing.schedule(empty).count() == mixing.mixed(empty).count() == 0
    assert toxicity.scored(empty, toxicity.fit(empty, labels)).count() == 0
    assert order.materialise(empty, f"{folder}/none").count() == 0
    assert warc.derivatives(warc.responses(llm.createDataFrame([], "page_id bigint, url string, html string"))).count() == 0


@pytest.fixture()
def sf_dir(awkward, labels, folder):
    awkward.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_take_awkward_and_empty_rows(llm, sf_dir, empty):
    docs, columns = llm.read.parquet(f"{sf_dir}/documents.parquet"), empty.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out, none = stage(llm, docs, sf_dir), stage(llm, empty, sf_dir)
        assert none.count() == 0 and (name == "packing" or out.columns == none.columns == columns)
        out.write.parquet(f"{sf_dir}/{name}")
        docs = llm.read.parquet(f"{sf_dir}/{name}")
    assert corpus_pipeline.run(llm, sf_dir).count() == docs.count() > 0


def test_pipeline_against_plain_versions(llm):
    """Each stage on what the one before kept, over the smallest data."""
    sf_dir = "/root/testdata/sf0.001"
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    (_, drop_toxic), (_, exactly), (_, nearly), (_, mix), (_, pack) = corpus_pipeline.STAGES
    clean = drop_toxic(llm, docs, sf_dir).cache()
    model = toxicity.fit(docs, llm.read.parquet(f"{sf_dir}/labels.parquet"))
    decoder = toxicity.Decoder(model.cost)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect() if model.score(decoder, r.text) < 0.3}
    first = {}
    for r in sorted(clean.collect()):
        first.setdefault(squeezed(r.text), r)
    single = exactly(llm, clean, sf_dir).cache()
    assert sorted(single.collect()) == sorted(first.values())
    kept = []
    for r in sorted(single.collect()):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), r.text).split()
        kept.append((r, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    label = list(range(len(kept)))
    for i, (_, a) in enumerate(kept):
        for j in range(i):
            b = kept[j][1]
            if a and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    near = nearly(llm, single, sf_dir).cache()
    assert sorted(near.collect()) == [r for n, (r, _) in enumerate(kept) if label[n] == n]
    mixed = mix(llm, near, sf_dir)
    slots = {r.row.doc_id: (r.slot, r.start) for r in mixing.schedule(near).collect()}
    rows = mixed.collect()
    assert sorted(rows) == sorted(near.collect()) and [slots[r.doc_id] for r in rows] == sorted(slots.values())
    packed = pack(llm, mixed, sf_dir).collect()
    assert sum(r.length for r in packed) == sum(len(encode(r.text, BYTE_BPE)) + 1 for r in rows)


def test_the_labelled_sample_is_bounded_in_rows(llm):
    """Two labelled keys with thousands of different texts each, and a limit of two."""
    docs = llm.range(6000).selectExpr("id % 3 AS doc_id", "concat('text ', id) AS text")
    labels = llm.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id bigint, toxic int")
    rows = toxicity._sampled(docs, labels, "doc_id", "text", 2).collect()
    assert len(rows) == 2 and rows == toxicity._sampled(docs.repartition(7), labels, "doc_id", "text", 2).collect()
