"""One registered query per operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import exact, fim, gnat, licenses, minhash, mixing, order, packing, substrings, syncmers, tokencount, toxicity, warc
from stratiform.llm.base import query, table
from stratiform.session import scratch_dir


def _replaced(sql: str, pairs: dict[str, str]) -> str:
    for name, character in pairs.items():
        sql = f"replace({sql}, '&{name};', '{character.replace(chr(39), chr(39) * 2)}')"
    return sql


def _id_sql(kind: str, parts: str) -> str:
    h = f"md5('{kind}|' || {parts})"
    return f"('<urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-' || {h}[13:16] || '-' || {h}[17:20] || '-' || {h}[21:32] || '>')"


_SHOWN_SQL = r"regexp_replace(regexp_replace(payload, '{0}', ' ', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')".replace("{0}", warc.HIDDEN)
_SHOWN_SQL = f"regexp_replace(regexp_replace({_SHOWN_SQL}, '{warc.BLOCK}', chr(10), 'g'), '{warc.TAG}', '', 'g')"
_TITLE_SQL = r"regexp_replace(regexp_extract(payload, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '[\x20\x09-\x0D]+', ' ', 'g')"
_RESPONSE_SQL = _id_sql("response", "coalesce(CAST(page_id AS varchar), '') || '|' || coalesce(url, '') || '|' || coalesce(html, '')")
_WARC_SQL = rf"""
WITH source AS (SELECT page_id, url, coalesce(html, '') AS payload, {_RESPONSE_SQL} AS refers_to, 'sha256:' || sha256(coalesce(html, '')) AS source_digest FROM pages),
lines AS (
    SELECT *, {_replaced(_SHOWN_SQL, {**warc.NAMED, "amp": "&"})} AS t,
           nullif(trim({_replaced(_TITLE_SQL, {**warc.NAMED, "amp": "&"})}), '') AS title,
           nullif(regexp_extract(payload, '(?is)<html\b[^>]*\blang="?([A-Za-z-]+)', 1), '') AS lang,
           len(regexp_extract_all(payload, '(?is)<a\b[^>]*\bhref=')) AS links, chr(13) || chr(10) AS n FROM source),
ids AS (
    SELECT *, regexp_replace(regexp_replace(regexp_replace(t, ' *\n[ \n]*', chr(10), 'g'), ' +', ' ', 'g'), '^[ \n]+|[ \n]+$', '', 'g') AS plain,
           {_id_sql("conversion", "refers_to")} AS conversion_id, {_id_sql("metadata", "refers_to")} AS metadata_id FROM lines),
blocks AS (
    SELECT *, 'source-header: HTTP/1.1 200 OK' || n || 'source-header: Content-Type: text/html; charset=utf-8' || n || 'source-header: Content-Length: ' || strlen(payload)
           || n || 'source-payload-digest: ' || source_digest || n || 'source-payload-length: ' || strlen(payload) || n || 'conversion-record-id: ' || conversion_id
           || coalesce(n || 'title: ' || title, '') || coalesce(n || 'language: ' || lang, '') || n || 'outlinks: ' || links || n AS fields FROM ids),
records AS (
    SELECT page_id, url, 'conversion' AS kind, conversion_id AS record_id, refers_to, source_digest, plain AS block, 'text/plain; charset=utf-8' AS type, NULL AS beside, n FROM blocks
    UNION ALL
    SELECT page_id, url, 'metadata', metadata_id, refers_to, source_digest, fields, 'application/warc-fields', conversion_id, n FROM blocks)
SELECT page_id, url, kind, record_id, refers_to, source_digest, block, 'sha256:' || sha256(block) AS block_digest,
       'WARC-Type: ' || kind || n || 'WARC-Record-ID: ' || record_id || coalesce(n || 'WARC-Target-URI: ' || url, '') || n || 'WARC-Refers-To: ' || refers_to
       || coalesce(n || 'WARC-Concurrent-To: ' || beside, '') || n || 'Content-Type: ' || type || n || 'WARC-Block-Digest: sha256:' || sha256(block) || n || 'Content-Length: ' || strlen(block) AS headers
FROM records"""


@query("op1_warc_derivatives", "pages", sql=_WARC_SQL)
def warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of every page."""
    found = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return found.withColumnsRenamed({"source_key": "page_id", "target_uri": "url"})


_NEAR_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
    FROM texts, unnest(range(1, greatest(len(w) - 3, 1) + 1)) t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
    SELECT x, y FROM shared JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y WHERE 100 * c >= 80 * (sx.n + sy.n - c)),
links AS (SELECT x, y FROM linked UNION SELECT y, x FROM linked),
reached(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id,
       d.doc_id <= coalesce(min(r.y), d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reached r ON r.x = d.doc_id GROUP BY d.doc_id"""


@query("op2_bayes_minhash", "documents", sql=_NEAR_SQL)
def bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its near-duplicates, on shingles of four words."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)
    kept = F.col("key").eqNullSafe(F.col("component_id"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


@query("op3_best_two_fit_packing", "documents")
def best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into pieces and packed into sequences of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


@query(
    "op4_digest_index_dedup", "documents",
    sql=r"""
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1 AS kept, h AS text_sha256
    FROM d WINDOW g AS (PARTITION BY h)""",
)
def digest_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents deduplicated by the index in two batches: the lower half of the ids, then the rest."""
    docs = table(spark, sf_dir, "documents")
    index = exact.new_index(spark, docs.schema["doc_id"].dataType.simpleString())
    staged = exact.stage(docs, columns=False)
    low, high = staged.agg(F.min("key"), F.max("key")).first()
    first = F.coalesce(F.col("key") <= (low + high) // 2, F.lit(False)) if low is not None else F.lit(True)
    index.append(staged.where(first))
    index.append(staged.where(~first))
    decided = exact.decide(index, staged)
    return decided.select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def learnable(labels: DataFrame) -> DataFrame:
    """Labels outside the fold that is held out."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


@query("op5_deobfuscated_toxicity", "documents", "labels")
def deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every restored text, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels")))
    found = toxicity.scored(docs, model).select("row.doc_id", "score")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op6_training_order", "documents")
def training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of every document with its slot, shard and byte offset; the shards are written."""
    return order.materialise(table(spark, sf_dir, "documents"), scratch_dir(spark, "training-order"))


@query("op7_closed_syncmers", "documents")
def closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of the text half replaced by the next one, and how alike they are."""
    found = syncmers.with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    head, tail = syncmers.halves(F.col("text"), F.col("next_text"))
    marked = found.withColumns({
        "edited": F.concat(head, tail), "edited_marks": syncmers.joined_anchors(head, F.col("found"), tail, F.col("next_found")),
        "marks": F.col("found.mark"), "next_marks": F.col("next_found.mark"),
    })
    return marked.select(
        "row.doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.written(F.col("marks")).alias("fingerprint"), syncmers.written(F.col("edited_marks")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        syncmers.likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )


_REPEATS_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM texts, unnest(range(1, len(w) - 33)) t(i)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY g) > 1),
covered AS (SELECT DISTINCT doc_id, i + k AS p FROM again, range(0, 35) r(k)),
words AS (SELECT doc_id, p, w[p] AS word FROM texts, unnest(range(1, len(w) + 1)) t(p)),
kept AS (SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY words.p) AS s
         FROM words LEFT JOIN covered ON covered.doc_id = words.doc_id AND covered.p = words.p WHERE covered.p IS NULL GROUP BY words.doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)"""


@query("op8_super_kmer_dedup", "documents", sql=_REPEATS_SQL)
def super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows of 35 words that occur again."""
    found = substrings.cleaned(table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


_MIX_SQL = f"""
WITH RECURSIVE rows_ AS (
    SELECT doc_id, coalesce(source, '') AS source, length(coalesce(text, '')) + 1 AS mass,
           md5(coalesce(CAST(doc_id AS varchar), '')) AS place, md5(coalesce(text, '')) AS tie
    FROM documents),
targets AS (SELECT source, CAST(sum(mass) AS bigint) AS mass, sqrt(CAST(sum(mass) AS double)) AS weight FROM rows_ GROUP BY source),
weights AS (
    SELECT source, (mass + {mixing.BLOCK_CHARS - 1}) // {mixing.BLOCK_CHARS} AS n,
           greatest(1, CAST(floor(weight / (SELECT max(weight) FROM targets) * {float(mixing.UNITS)}::double) AS hugeint)) AS w FROM targets),
setup AS (SELECT CAST(sum(w) AS hugeint) AS p, list(w ORDER BY source) AS s, list(n ORDER BY source) AS n, list(source ORDER BY source) AS names FROM weights),
finish AS (SELECT max((n * p + w - 1) // w) AS last FROM weights, (SELECT p FROM setup)),
edf AS (
    SELECT CAST(-1 AS bigint) AS slot, list_transform(s, lambda x: CAST(0 AS hugeint)) AS done, CAST(0 AS bigint) AS i FROM setup
    UNION ALL
    SELECT t, list_transform(range(1, len(done) + 1), lambda k: done[k] + CASE WHEN k = pick THEN 1 ELSE 0 END), pick
    FROM (SELECT t, done, CASE WHEN best < 1000000000000000000000 THEN CAST(best % 100000 AS bigint) ELSE 0 END AS pick
          FROM (SELECT slot + 1 AS t, done, list_min(list_transform(range(1, len(s) + 1), lambda k:
                    CASE WHEN done[k] < n[k] AND done[k] * p // s[k] <= slot + 1 THEN ((done[k] + 1) * p + s[k] - 1) // s[k] ELSE 10000000000000000 END * 100000 + k)) AS best
                FROM edf, setup, finish WHERE slot + 1 < last))),
turns AS (SELECT names[i] AS source, slot, row_number() OVER (PARTITION BY i ORDER BY slot) - 1 AS block FROM edf, setup WHERE i > 0),
started AS (
    SELECT *, coalesce(sum(mass) OVER (PARTITION BY source ORDER BY place, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM rows_)
SELECT doc_id, source, turns.block, CAST(start AS bigint) AS start, turns.slot,
       CAST(turns.block * p // w AS bigint) AS release, CAST(((turns.block + 1) * p + w - 1) // w AS bigint) AS due
FROM started JOIN weights USING (source) JOIN turns USING (source), setup WHERE turns.block = start // {mixing.BLOCK_CHARS}"""


@query("op9_pfair_mixing", "documents", sql=_MIX_SQL)
def pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its block and slot in the mixture of sources, targets by the root of their size."""
    placed = mixing.schedule(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return placed.select("row.doc_id", F.col("source_name").alias("source"), "block", "start", "slot", "release", "due")


@query("op10_transducer_token_counts", "documents")
def transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by the compiled transducer."""
    counted = tokencount.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query("op11_rare_word_licenses", "documents")
def rare_word_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every text: places of the base phrases, all labels, and the share of the best verified template."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scanned(docs, licenses.index(docs)).withColumn("own", F.filter("places", lambda p: p["base"]))

    def listed(places: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "row.doc_id", "n_words", F.size("own").cast("long").alias("n_base"), F.array_min("own.start").alias("first_word"), F.array_max("own.start").alias("last_word"),
        listed("own").alias("base_labels"), listed("places").alias("labels"), F.coalesce(F.array_max("places.share"), F.lit(0.0)).alias("score"),
    )


def _assigned_sql(book: str) -> str:
    return f"""(
    SELECT r, p, any_value(q) AS q, arg_min(e, d * 1000 + e) AS e, min(d) AS d
    FROM (SELECT r, parts.p, q, e, CAST(list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS bigint) AS d
          FROM parts JOIN {book} b ON b.p = parts.p)
    GROUP BY r, p)"""


def _moved_sql(book: str, assigned: str) -> str:
    return f"""(
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (
        SELECT p, e, list(CAST((t - (t % n + n) % n) // n AS bigint) ORDER BY k) AS c
        FROM (SELECT p, e, k, CAST(sum(q[k]) AS bigint) AS t, count(*) AS n FROM {assigned} a, unnest(range(1, len(q) + 1)) u(k) GROUP BY p, e, k)
        GROUP BY p, e) m USING (p, e))"""


_CODES_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS r, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS double)) AS bigint)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS q FROM kept, unnest(range(0, 16)) u(p)),
book0 AS MATERIALIZED (SELECT p, r AS e, q AS c FROM parts WHERE r < 64),
near0 AS MATERIALIZED {_assigned_sql("book0")},
book1 AS MATERIALIZED {_moved_sql("book0", "near0")},
near1 AS MATERIALIZED {_assigned_sql("book1")},
book2 AS MATERIALIZED {_moved_sql("book1", "near1")},
near2 AS MATERIALIZED {_assigned_sql("book2")},
codes AS (SELECT r, string_agg(lower(lpad(printf('%x', e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS bigint) AS error FROM near2 GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256 FROM kept JOIN codes USING (r), books"""


@query("op12_gnat_vector_codes", "embeddings", sql=_CODES_SQL)
def gnat_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every usable vector, its error, that of its label, and the hash of the trained codebooks."""
    codes, books = gnat.quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    found = gnat.by_label(codes, "label")
    return found.select("row.vec_id", "code", "error", "label_error", F.lit(books.digest() if books else "").alias("codebooks_sha256"))


_MIDDLE_SQL = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS varchar), '')) AS h FROM documents),
drawn AS (
    SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS bigint) AS h1, CAST('0x' || h[9:16] AS bigint) AS h2,
           CAST('0x' || h[17:24] AS bigint) AS h3, CAST('0x' || h[25:32] AS bigint) AS h4 FROM units),
cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM cuts)
SELECT doc_id, CAST(n AS bigint) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""


@query("op13_piece_table_middle", "documents", sql=_MIDDLE_SQL)
def piece_table_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two lines and rearranged, with the hash of the output and of the document restored from it."""
    found = fim.transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
