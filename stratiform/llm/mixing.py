"""Mixing sources to target weights by proportionate-fair scheduling of blocks.

A source with the weight w of a total W gets its block j released at floor(j * W / w) and due at
ceil((j + 1) * W / w), in whole numbers: weights are read to 2**-40 of the largest. Of the released blocks, the
one due first takes the next slot, then the one whose source comes first by name. Every block runs inside its window, so no source is ever a whole
block before or behind its target. There is no period, and neither shares nor sources are capped.

Time is cut into ranges that are scheduled apart from each other, since the state at a border
follows from the releases alone. With J(u) blocks released before u, h(u) = J(u) - u and m(t) the least h up to t,
h(t) - m(t) blocks are waiting at t. They are among the blocks whose window spans the border, one
of each source at most. Of those released by r, no more than the least h between r and t, less m(t), can be waiting, and
earliest deadline first leaves the latest deadlines waiting that these bounds allow. A range then takes what waits
and what it releases, by deadline, each into its first free slot. The result is that of one queue
over all of time. A range has as many blocks as slots and sources, so no task grows with the data.

Blocks are equal masses of text in a fixed random order of the source's rows. All of it is
DataFrame functions. Defined results:

* a row's mass is its number of characters and one; NULL text counts as empty;
* a NULL source counts as the source named by the empty text; a source without a target, or with
  a target of NULL, zero, less or no number, gets 1/64 of the largest target;
* rows of a source are ordered by the MD5 of their key, then that of their text, NULL as empty;
  rows alike in both are alike in their place but for the mass before them;
* a row longer than a block takes the time of all the blocks that it fills;
* no row is dropped: slots of a source that has run out stay empty if nothing else is released;
* an empty table gives an empty result; other input columns ride along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.base import filled, stored

BLOCK_CHARS = 1 << 16  # of one block
UNKNOWN = 64  # a source without a target gets this part of the largest
UNITS = 1 << 40  # the largest weight as a whole number
RANGE_SLOTS = 1 << 12  # slots of a range, if there are not more sources
BLOCKS_A_TASK = 1 << 16  # listed together
ROWS_A_CHUNK = 4096  # aimed at, for running sums


def _mass(text: str) -> Column:
    return F.length(filled(text)).cast("long") + 1


def tempered(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Targets by the root of each source's mass, which lifts small sources: ``source``, ``weight``."""
    mass = docs.groupBy(filled(source).alias("source")).agg(F.sum(_mass(text)).alias("mass"))
    return mass.select("source", F.sqrt(F.col("mass").cast("double")).alias("weight"))


def whole_weights(sources: DataFrame) -> DataFrame:
    """``sources`` with ``units``, their ``weight`` as a whole number, at least 1."""
    weight = F.col("weight")
    good = weight.isNotNull() & ~F.isnan(weight) & (weight > 0) & (weight < float("inf"))
    known = sources.withColumn("weight", F.when(good, weight))
    top = known.agg(F.max("weight")).scalar()
    units = F.floor(F.col("weight") / top * F.lit(float(UNITS)))
    return known.withColumn("units", F.greatest(F.lit(1), F.when(top.isNull(), UNITS).otherwise(F.coalesce(units, F.lit(UNITS // UNKNOWN)))).cast("long"))


def windows(sources: DataFrame) -> DataFrame:
    """Every block of ``source``, ``units``, ``blocks`` with its ``release`` and ``due``; long lists are dealt out in parts."""
    total = sources.where("blocks > 0").agg(F.sum(F.col("units").cast("decimal(20,0)")).cast("decimal(20,0)")).scalar()
    parts = sources.where("blocks > 0").select("source", "units", "blocks", total.alias("total"), F.explode(F.expr(f"sequence(0L, (blocks - 1) DIV {BLOCKS_A_TASK})")).alias("part"))
    first = f"part * {BLOCKS_A_TASK}"
    each = parts.repartition("source", "part").withColumn("block", F.explode(F.expr(f"sequence({first}, least(blocks, {first} + {BLOCKS_A_TASK}) - 1)")))
    return each.select(
        F.col("source").alias("source_name"), "block",
        F.expr("CAST(block AS decimal(17,0)) * total DIV units").alias("release"), F.expr("(CAST(block + 1 AS decimal(17,0)) * total + units - 1) DIV units").alias("due"),
    )


def _borders(released: DataFrame, spanned: DataFrame, slots: int) -> DataFrame:
    """``range``, ``h``, ``least`` (m) and ``low``, the least h up to the next border, where a range begins.

    A row for each range, so the running sum is over T / slots rows.
    """
    in_range = released.groupBy("range").agg(F.count("*").alias("n"), F.min("above").alias("low"))
    listed = in_range.unionByName(spanned.select("range", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("low")))
    each = listed.groupBy("range").agg(F.sum("n").alias("n"), F.min("low").alias("low"))
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    h = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("range") * slots
    at = each.withColumn("h", h).select("range", "h", (F.col("h") + F.least("low", F.col("n") - slots)).alias("low"))
    return at.withColumn("least", F.least(F.lit(0), F.col("h"), F.coalesce(F.min("low").over(before), F.lit(0))))


_WAITING = """
    aggregate(listed, named_struct('room', transform(listed, x -> named_struct('release', x.release, 'left', x.most)), 'out', filter(listed, x -> false)),
        (state, x) -> IF(exists(state.room, q -> q.release >= x.release AND q.left < 1), state, named_struct(
            'room', transform(state.room, q -> named_struct('release', q.release, 'left', IF(q.release >= x.release, q.left - 1, q.left))),
            'out', concat(state.out, array(x)))),
        state -> state.out)"""

_SLOTS = """
    aggregate(listed, named_struct('busy', CAST(array() AS array<struct<a:bigint,b:bigint>>), 'out', CAST(array() AS array<struct<slot:bigint,i:int>>)),
        (state, x) -> transform(array(greatest(x.release, {begin})), at -> transform(array(coalesce(get(filter(state.busy, v -> v.a <= at AND at < v.b), 0).b, at)), slot ->
            named_struct(
                'busy', concat(filter(state.busy, v -> v.b <> slot AND v.a <> slot + 1), array(named_struct(
                    'a', coalesce(get(filter(state.busy, v -> v.b = slot), 0).a, slot), 'b', coalesce(get(filter(state.busy, v -> v.a = slot + 1), 0).b, slot + 1)))),
                'out', concat(state.out, array(named_struct('slot', slot, 'i', size(state.out))))))[0])[0],
        state -> filter(array_sort(state.out), x -> x.slot < {begin} + {slots}))"""


def turn_table(sources: DataFrame, range_slots: int | None = None) -> DataFrame:
    """Earliest deadline first over ``source``, ``weight``, ``blocks``: ``source_name``, ``block``, ``slot``, ``release``, ``due`` and ``turn``, the number of blocks before by slot."""
    known = stored(whole_weights(sources).select("source", "units", F.col("blocks").cast("long").alias("blocks")), "sources")
    slots = range_slots or max(RANGE_SLOTS, 1 << known.count().bit_length())
    by_release = Window.partitionBy("range").orderBy("release")
    later = Window.partitionBy("range").orderBy(F.desc("release")).rangeBetween(Window.unboundedPreceding, -1)
    listed = windows(known).withColumn("range", F.expr(f"release DIV {slots}"))
    # above: h at the release, rest: the least h behind it up to the border, both less h where the range begins
    released = listed.withColumn("above", (F.rank().over(by_release) - 1 - (F.col("release") - F.col("range") * slots)).cast("long"))
    released = stored(released.withColumn("rest", F.least(F.min("above").over(later), F.count("*").over(Window.partitionBy("range")) - slots)), "windows")
    last = F.expr(f"(due - 1) DIV {slots}")
    spanning = released.where(last > F.col("range")).withColumn("border", F.explode(F.sequence(F.col("range") + 1, last)))
    borders = stored(_borders(released, spanning.select(F.col("border").alias("range")).distinct(), slots), "borders")
    behind = borders.select((F.col("range") + 1).alias("border"), F.col("h").alias("h_before"), "low")
    here = borders.where("h > least").select(F.col("range").alias("border"), "h", "least")
    since = F.when(F.col("border") == F.col("range") + 1, F.col("h_before") + F.col("rest")).otherwise(F.col("low"))
    so_far = F.min("since").over(Window.partitionBy("source_name", "block").orderBy("border"))
    bounded = spanning.join(behind, "border").withColumn("since", since).withColumn("so_far", so_far).join(here, "border")
    one = F.struct("due", "source_name", "block", "release", (F.least("h", "so_far") - F.col("least")).alias("most"))
    waiting = bounded.groupBy("border").agg(F.sort_array(F.collect_list(one), asc=False).alias("listed"))
    waiting = waiting.select(F.col("border").alias("range"), F.inline(F.expr(_WAITING)))
    columns = ["range", "source_name", "block", "release", "due"]
    together = released.select(*columns).unionByName(waiting.select(*columns)).groupBy("range").agg(F.array_sort(F.collect_list(F.struct("due", "source_name", "block", "release"))).alias("listed"))
    began = borders.select("range", (F.col("range") * slots + F.col("least")).alias("done"))
    begin = f"`range` * {slots}"
    placed = together.join(began, "range").withColumn("taken", F.expr(_SLOTS.format(begin=begin, slots=slots)))
    each = placed.select("listed", "done", F.posexplode("taken").alias("n", "at")).select("done", "n", "at.slot", F.expr("listed[at.i]").alias("x"))
    return each.select("x.source_name", "x.block", "slot", "x.release", "x.due", (F.col("done") + F.col("n")).alias("turn"))


def schedule(
    docs: DataFrame, targets: DataFrame | None = None, key: str = "doc_id", source: str = "source", text: str = "text",
    block_chars: int = BLOCK_CHARS, columns: list[str] | None = None,
) -> DataFrame:
    """All rows as ``row`` (a struct of ``columns``, by default all) with ``source_name``, ``block``, ``slot``, ``release``, ``due``, ``start`` and ``turn``.

    Sorted by (``slot``, ``start``) the rows are the mixture; ``start`` is the mass of the source
    before a row, ``turn`` counts the blocks of all sources by slot. Running sums go in two steps, chunks of a source and rows of a chunk, so that no
    source meets in one task, however large it is.
    """
    digits = max(1, -(-max(0, (docs.count() // ROWS_A_CHUNK).bit_length()) // 4))
    place = F.md5(filled(F.col(key).cast("string")))
    rows = docs.select(
        F.struct(*(f"`{c}`" for c in columns or docs.columns)).alias("row"), filled(source).alias("source_name"), place.alias("place"), F.md5(filled(text)).alias("tie"), _mass(text).alias("mass")
    ).withColumn("chunk", F.substring("place", 1, digits))
    sums = rows.groupBy("source_name", "chunk").agg(F.sum("mass").alias("chunk_mass"))
    before = Window.partitionBy("source_name").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source_name", "chunk", F.coalesce(F.sum("chunk_mass").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_name", "chunk").orderBy("place", "tie").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("mass").over(inside), F.lit(0))
    base = stored(base.join(sums, ["source_name", "chunk"]).select("source_name", "chunk", "base", "chunk_mass"), "chunks")
    masses = base.groupBy(F.col("source_name").alias("source")).agg(F.sum("chunk_mass").alias("mass"))
    if targets is None:
        weighted = masses.withColumn("weight", F.sqrt(F.col("mass").cast("double")))
    else:
        known = targets.groupBy(filled("source").alias("source")).agg(F.max(F.col("weight").cast("double")).alias("weight"))
        weighted = masses.join(known, "source", "left")
    drawn = stored(turn_table(weighted.withColumn("blocks", F.expr(f"(mass + {block_chars - 1}) DIV {block_chars}"))), "turns")
    # a chunk knows the slots of its own blocks, so its rows need no shuffle of their own for them
    own = base.withColumn("block", F.explode(F.expr(f"sequence(base DIV {block_chars}, (base + chunk_mass - 1) DIV {block_chars})")))
    listed = own.join(drawn, ["source_name", "block"]).groupBy("source_name", "chunk", "base").agg(F.array_sort(F.collect_list(F.struct("block", "slot", "release", "due", "turn"))).alias("own"))
    placed = rows.join(listed, ["source_name", "chunk"]).withColumn("start", start).withColumn("block", F.expr(f"start DIV {block_chars}"))
    found = placed.withColumn("at", F.expr(f"own[CAST(block - base DIV {block_chars} AS int)]"))
    return found.select("row", "source_name", "block", "start", "at.slot", "at.release", "at.due", "at.turn")


def mixed(docs: DataFrame, targets: DataFrame | None = None, **columns: str) -> DataFrame:
    """All rows of ``docs`` in the order of the mixture: ranges of slots, sorted, one after the other.

    Files written from it hold the mixture when they are read in the order of their names.
    """
    placed = schedule(docs, targets, **columns)
    return placed.repartitionByRange("slot", "start").sortWithinPartitions("slot", "start").select("row.*")
