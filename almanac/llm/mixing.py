"""Mixing sources to target weights with a low-discrepancy schedule.

Every source is a stream of its words in shuffled document order, repeated as often as needed and cut into blocks of
BLOCK words. The mix is a row of slots, one block each. Slot i stands at the van der Corput point of i, the bits of
i read backwards behind the binary point; the point falls into the interval of a source on the scale of cumulative
targets, so any stretch of the schedule holds every source very nearly in proportion. The slots of a source are
ranked, and the point of rank r takes the r-th block of its stream. A source takes exactly its target, rounded: its last
block is shortened, and further points of it are passed over. At least POINTS times as many points as slots are drawn,
a power of two of them, so only sources of about a block may be missed by all; a block of theirs stands at a point of the
same sequence that counts for it alone. Slots are the points that count, numbered in order.

Totals along a source and ranks of slots are running totals over even range slices, and blocks meet documents by
(source, block), so a source with a third of all words is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.batches import with_plain_names
from almanac.operators.running import numbered, running_totals
from almanac.sources import materialise, table

BLOCK = 256
SEED = 17
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
CELLS = 4096
POINTS = 2


def van_der_corput(i: Column) -> Column:
    """The bits of a non-negative long in reverse order behind the binary point, to 53 bits."""
    masks = (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x00FF00FF00FF00FF, 0x0000FFFF0000FFFF)
    for step, mask in enumerate(masks):
        width = 1 << step
        kept = F.lit(mask)
        i = F.shiftrightunsigned(i, width).bitwiseAND(kept).bitwiseOR(F.shiftleft(i.bitwiseAND(kept), width))
    i = F.shiftrightunsigned(i, 32).bitwiseOR(F.shiftleft(i, 32))
    return F.shiftrightunsigned(i, 11).cast("double") * F.lit(2.0**-53)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """n, source, source_size and target of every source, from rows of source and size.

    Sources are numbered by code point, null last, and weighted in turn. Targets share the sum of sizes by weight; one
    that would be more than ``most`` times its source's size stops there and the excess is shared again. Only two
    sums a round come to the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("n") - 1, F.lit(len(weights))).cast("int") + 1)
    sources = materialise(numbered(totals, "n", (), order).withColumn("weight", turn), "sources")
    size, weight = F.col("source_size"), F.col("weight")
    level = None
    while True:
        capped = F.lit(False) if level is None else weight * F.lit(level) > size * most
        left, shares = sources.agg(
            F.sum(size) - F.coalesce(F.sum(F.when(capped, size * most)), F.lit(0)), F.sum(F.when(~capped, weight))
        ).first()
        found = float(left) / float(shares) if shares else level or 0.0
        if found == level or not shares:
            break
        level = found
    return sources.select(
        "n", "source", "source_size",
        F.least(size.cast("double") * most, weight * F.lit(level or 0.0)).alias("target"),
        F.floor(F.least(size.cast("double") * most, weight * F.lit(level or 0.0)) + 0.5).cast("long").alias("quota"),
    )


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """n, slot, rank (from 0), start and words: the block of the repeated stream of its source that each slot takes.

    Slots are numbered from 0 without a gap, and each has one block.
    """
    ends = materialise(running_totals(sources, {"high": F.col("quota")}, [F.col("n")]), "cumulated")
    found = ends.agg(F.max("high"), F.count("*")).first()
    total, n_sources = int(found[0] or 0), int(found[1])
    slots = -(-total // block)
    # Intervals and points meet in cells of the scale; a cell holds few intervals, however many sources there are.
    cells = CELLS
    while cells < 4 * n_sources:
        cells *= 2
    whole = F.lit(float(max(1, total)))
    intervals = ends.filter("quota > 0").select(
        "n", "quota", ((F.col("high") - F.col("quota")) / whole).alias("low"), (F.col("high") / whole).alias("high")
    )
    first = F.floor(F.col("low") * cells)
    last = F.least(F.ceil(F.col("high") * cells) - 1, F.lit(cells - 1))
    intervals = intervals.withColumn("cell", F.explode(F.sequence(first, F.greatest(first, last))))
    # Of the first 2^k points each interval between neighbours of the grid of 2^-k has one.
    drawn = 1 << (POINTS * slots - 1).bit_length() if slots else 0
    points = ends.sparkSession.range(drawn).select(F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("point"))
    placed = points.withColumn("cell", F.floor(F.col("point") * cells)).join(intervals, "cell").filter(
        (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
    )
    ranked = numbered(placed.select("n", "quota", "slot"), "rank", ("n",), [F.col("slot")]).withColumn("rank", F.col("rank") - 1)
    used = ranked.filter(F.col("rank") * block < F.col("quota"))
    reached = used.groupBy("n").agg(F.max("rank").alias("reached"), F.max("slot").alias("last"))
    blocks = F.ceil(F.col("quota") / block)
    missing = ends.join(reached, "n", "left").withColumn("next", F.coalesce(F.col("reached") + 1, F.lit(0)))
    missing = missing.filter((F.col("quota") > 0) & (F.col("next") < blocks)).select(
        "n", "quota", "next", "last", (blocks - F.col("next")).alias("many"),
        F.explode(F.sequence(F.col("next"), blocks.cast("long") - 1)).alias("rank"),
    )
    # Behind the last point of the source, or from a point of its own on, evenly over the rest of the slots.
    base = F.coalesce(F.col("last").cast("double"), van_der_corput(F.col("n")) * slots)
    between = F.floor(base + (F.col("rank") - F.col("next")) * F.greatest(slots - base, F.lit(1.0)) / F.col("many")) + 0.5
    start = F.col("rank") * block
    known = used.select("n", "quota", "rank", F.col("slot").cast("double").alias("place")).unionByName(
        missing.select("n", "quota", "rank", between.alias("place"))
    )
    return numbered(known, "slot", (), [F.col("place"), F.col("n"), F.col("rank")]).select(
        "n", (F.col("slot") - 1).alias("slot"), "rank", start.alias("start"), F.least(F.lit(block), F.col("quota") - start).cast("long").alias("words")
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def _placed(
    docs: DataFrame, block: int, weights: tuple[int, ...], most: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """The streams, a row per document, and the parts that the slots take of them.

    Streams have doc_id, source, text_key, size, n, source_size, target, begin and end. A part has the n, begin,
    doc_id, source, text_key and size of its document, slot, rank and turn, and the words from low up to high of the
    stream; a slot takes a document in one part for each cell of the stream they share.
    """
    shuffled = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    sizes = materialise(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key"),
        shuffled.alias("place"),
    ), "sizes")
    sources = materialise(source_targets(sizes, weights, most), "targets")
    known = sources.select("n", F.col("source").alias("_source"), "source_size", "target")
    ordered = [F.col("place"), F.col("doc_id"), F.col("size"), F.col("text_key")]
    numbered_sizes = sizes.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    streams = materialise(running_totals(numbered_sizes, {"end": F.col("size")}, ordered, ("n",)), "streams")
    streams = streams.withColumn("begin", F.col("end") - F.col("size"))

    # A slot is one to a few spans of the stream: it is cut where the stream begins anew.
    slots = schedule(sources, block).join(known.select("n", "source_size"), "n")
    length, stop = F.col("source_size"), F.col("start") + F.col("words")
    spans = slots.withColumn(
        "turn", F.explode(F.sequence(F.floor(F.col("start") / length), F.floor((stop - 1) / length)))
    ).select(
        "n", "slot", "rank", "turn", F.greatest(F.col("start") - F.col("turn") * length, F.lit(0)).alias("from"),
        F.least(stop - F.col("turn") * length, length).alias("to"),
    )

    def by_block(rows: DataFrame, begin: str, end: str) -> DataFrame:
        cell = F.explode(F.sequence(F.floor(F.col(begin) / block), F.floor((F.col(end) - 1) / block)))
        return rows.withColumn("cell", cell)

    def inside(side: str, begin: str, end: str) -> list[Column]:
        low = F.greatest(F.col(begin), F.col("cell") * block).alias(f"{side}0")
        return [low, F.least(F.col(end), (F.col("cell") + 1) * block).alias(f"{side}1")]

    taken_spans = by_block(spans, "from", "to").select("n", "cell", "slot", "rank", "turn", *inside("s", "from", "to"))
    document = ("n", "begin", "doc_id", "source", "text_key", "size")
    cells = by_block(streams.filter("size > 0").select(*document, "end"), "begin", "end").select(
        "cell", *document, *inside("d", "begin", "end")
    )
    parts = cells.join(taken_spans, ["n", "cell"]).select(
        *document, "slot", "rank", "turn", F.greatest("s0", "d0").alias("low"), F.least("s1", "d1").alias("high")
    )
    return streams, parts.filter("low < high")


def scheduled(
    docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED
) -> DataFrame:
    """The mix itself: slot, source, rank, turn, doc_id, text_key, first and last of every stretch a slot takes.

    The words from ``first`` to ``last`` (from 0) of the document, in its ``turn`` (from 0) through the stream, stand in
    the slot, which is the block ``rank`` of the source. By slot, turn and place in the stream the rows are the mix in
    order; ``at``, the place, is the number of words of the source before the stretch in this turn.
    """
    _, parts = _placed(docs, block, weights, most, seed)
    stretches = parts.groupBy("n", "begin", "slot", "rank", "turn", "doc_id", "source", "text_key").agg(
        F.min("low").alias("at"), F.max("high").alias("_stop")
    )
    return stretches.select(
        "slot", "source", "rank", "turn", "at", "doc_id", "text_key",
        (F.col("at") - F.col("begin")).alias("first"), (F.col("_stop") - 1 - F.col("begin")).alias("last"),
    )


def mixed(
    docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED
) -> DataFrame:
    """doc_id, source, text_key, size, source_size, target and taken of every row.

    A null or empty text has size 0 and nothing is taken of it. A null source is a source of its own. Repeated rows are
    parts of the stream each; the shuffle is by a digest of the doc_id and the seed, then doc_id and size, so reruns
    agree as tables. Without any words all targets are 0. Other columns are not read.
    """
    streams, parts = _placed(docs, block, weights, most, seed)
    taken = parts.groupBy("n", "begin").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    return _with_taken(streams, taken).select(
        "doc_id", "source", "text_key", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def _with_taken(streams: DataFrame, taken: DataFrame) -> DataFrame:
    # A document without words has the place of the one that follows, but takes nothing.
    placed = streams.withColumn("at", F.when(F.col("size") > 0, F.col("begin"))).drop("begin")
    return placed.join(taken.withColumnRenamed("begin", "at"), ["n", "at"], "left")


def mixture(
    docs: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED
) -> DataFrame:
    """The documents as the mix takes them: each row as many times as its words are taken, to the nearest whole.

    The rows are in the order of the schedule, across partitions and inside them: a copy stands where the first slot
    that takes of its turn stands. At most one document of a source is taken in part, so this moves a source by no
    more than half a document. Documents without words are in no mix. Of equal rows each comes equally often.
    """
    docs, back = with_plain_names(docs)
    streams, parts = _placed(docs, block, weights, most, seed)
    turns = parts.groupBy("n", "begin", "turn").agg(
        F.sum(F.col("high") - F.col("low")).alias("taken"), F.min("slot").alias("slot")
    )
    taken = turns.groupBy("n", "begin").agg(
        F.sum("taken").alias("taken"), F.sort_array(F.collect_list(F.struct("turn", "slot"))).alias("turns")
    )
    # Equal rows are neighbours in the stream; their copies stand where those of the row taken most often do.
    rows = _with_taken(streams.filter("size > 0"), taken)
    takes = rows.groupBy("doc_id", "source", "text_key").agg(
        F.floor(F.sum(F.coalesce("taken", F.lit(0))) / F.sum("size") + 0.5).cast("int").alias("_copies"),
        F.max(F.struct(F.coalesce(F.size("turns"), F.lit(0)), "turns", "at")).alias("_most"),
    )
    keyed = takes.filter("_copies > 0").select(
        F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), F.col("text_key").alias("_key"),
        F.slice("_most.turns", F.lit(1), F.col("_copies")).alias("_turns"), F.col("_most.at").alias("_at"),
    )
    same = (
        docs["doc_id"].eqNullSafe(F.col("_doc")) & docs["source"].eqNullSafe(F.col("_source"))
        & (F.xxhash64(docs["text"]) == F.col("_key"))
    )
    copies = docs.join(keyed, same).select(*docs.columns, "_at", F.explode("_turns").alias("_copy"))
    order = [F.col("_copy.slot"), F.col("_copy.turn"), F.col("_at")]
    return back(copies.repartitionByRange(*order).sortWithinPartitions(*order).select(docs.columns))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(table(spark, folder, "documents", "doc_id", "text", "source")).drop("source", "text_key")


ORACLE = f"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{SEED}') AS place
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS z, row_number() OVER (ORDER BY source NULLS LAST) AS n
  FROM sizes GROUP BY source
), weighted AS (
  SELECT *, (n - 1) % {len(WEIGHTS)} + 1 AS w, (SELECT sum(z) FROM totals) AS total FROM totals
), lined AS (
  SELECT *, sum(w) OVER () AS all_w, row_number() OVER o AS k,
         coalesce(sum(z) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS z_before,
         coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before
  FROM weighted WINDOW o AS (ORDER BY z / w, n)
), level AS (
  SELECT CAST(total - {MOST_REPEATS} * z_before AS DOUBLE) / CAST(all_w - w_before AS DOUBLE) AS level FROM lined
  WHERE CAST(total - {MOST_REPEATS} * z_before AS DOUBLE) / CAST(all_w - w_before AS DOUBLE) * w <= {MOST_REPEATS} * z
  ORDER BY k LIMIT 1
), targets AS (
  SELECT source, n, z, least(CAST({MOST_REPEATS} * z AS DOUBLE), w * (SELECT level FROM level)) AS target FROM weighted
), placed AS (
  SELECT doc_id, size, z, target, CAST(floor(target + 0.5) AS BIGINT) AS quota,
         CAST(sum(size) OVER (PARTITION BY n ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS begin
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, z AS source_size, target,
       CAST(CASE WHEN z = 0 THEN 0 ELSE
         quota // z * size + greatest(0, least(begin + size, quota % z) - begin) END AS BIGINT) AS taken
FROM placed
"""

def mix_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return scheduled(table(spark, folder, "documents", "doc_id", "text", "source"))


QUERIES = {"op3_mixing": op3_mixing, "mix_schedule": mix_schedule}
ORACLES = {"op3_mixing": ORACLE}
