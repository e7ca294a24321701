"""Mixing sources to target weights with a low-discrepancy schedule.

Slot i of the mix is the point frac(i / golden ratio), written as a 32-bit fraction. The points
fall into the sources' shares of [0, 1); a slot's rank among those of its source names the block
that it takes: block (rank mod number of blocks) of the source's shuffled words, so a source that
is wanted more than once starts again after its last block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.common import WORD, row_hash, stored

#: floor(2^32 / golden ratio): the step of the Weyl sequence in 32-bit fractions.
STEP = 2654435769
#: Parts of [0, 1) by which slots meet the shares, and parts of a source's shuffled order that are summed apart.
CELLS, PARTS = 4096, 256


def _key(c: str) -> Column:
    """A source as a join key that tells null from any name."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias("key")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Per source: key, source_size, weight, target. sizes: key, source_size.

    Weights repeat over the sources in code-point order, a null source last. share of all words is
    dealt out by weight; a target stops at most times its source, the excess goes to the others by
    weight. With r = most * size / weight, the capped sources are a prefix in the order of r: those
    whose r is below the level at which the rest share what is left.
    """
    place = F.row_number().over(Window.orderBy(F.col("key") == "", "key")) - 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"wanted": F.sum("source_size").over(everything) * F.lit(float(share)), "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    rows = rows.withColumn("level", F.greatest(F.lit(0.0), F.col("wanted") - F.col("capped")) / F.col("open"))
    rows = rows.withColumn("free", F.col("level") * F.col("weight") < F.col("cap"))
    level = F.first(F.when(F.col("free"), F.col("level")), True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumn("target", F.least(F.col("cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))).select("key", "source_size", "weight", "target")


def blocks(shares: DataFrame, block: int, fine: int = 128) -> DataFrame:
    """shares with `block`: the words that one slot of a source takes, `block` at most and a fine-th of its target, and 1 at least."""
    return shares.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("target") / fine))).cast("long"))


def _met(shares: DataFrame, slots: int) -> DataFrame:
    """(slot, key): the source of each slot. shares: key, target."""
    spark = shares.sparkSession
    top = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = shares.select("key", F.sum("target").over(top).alias("upto"), F.sum("target").over(total).alias("whole")).where("whole > 0")
    ends = ends.select("key", F.round(F.col("upto") / F.col("whole") * float(2**32)).cast("long").alias("hi"))
    ends = ends.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("key")), F.lit(0))).where("hi > lo")
    width = 2**32 // CELLS
    ends = ends.select("key", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    # STEP - 2^32 gives the same points as STEP, and a product below 2^63 for all of the 2^32 slots after which they repeat
    points = spark.range(slots).select(F.col("id").alias("slot"), F.pmod((F.col("id") % F.lit(2**32)) * F.lit(STEP - 2**32), F.lit(2**32)).alias("point"))
    return points.withColumn("cell", F.floor(F.col("point") / width)).join(F.broadcast(ends), "cell").where("point >= lo and point < hi").select("slot", "key")


def schedule(shares: DataFrame, slots: int) -> DataFrame:
    """(slot, key, rank): the source of each slot and how many slots of that source came before it."""
    met = _met(shares, slots).withColumn("run", F.floor(F.col("slot") / 1024))
    return _ranked(met, "run", F.lit(1), ["slot"], "rank").select("slot", "key", "rank")


def slots_of(shares: DataFrame) -> DataFrame:
    """(key, slots): how many slots of the whole mix each source gets; their number grows with the words. shares: key, target, block."""
    wanted = shares.select("key", (F.col("target") / F.col("block")).alias("target"))
    whole = float(wanted.agg(F.sum("target")).first()[0] or 0)
    return _met(wanted, -int(-whole // 1)).groupBy("key").agg(F.count("*").alias("slots"))


def _ranked(rows: DataFrame, part: str, amount: Column, order: list, name: str) -> DataFrame:
    """rows with `name`: the sum of `amount` over the rows of the same key before it, in the order of (part, order).

    Sums per (key, part) first, so that no task holds all rows of a key.
    """
    rows = rows.withColumn("amount", amount)
    sums = rows.groupBy("key", part).agg(F.sum("amount").alias("in_part"))
    ahead = Window.partitionBy("key").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", part, F.coalesce(F.sum("in_part").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("key", part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("inside", F.coalesce(F.sum("amount").over(inside), F.lit(0))).join(sums, ["key", part]).withColumn(name, F.col("ahead") + F.col("inside")).drop("ahead", "inside", "amount")


def _sizes(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string").alias("source"), _key("source"), F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("draw"), *more)


def _planned(sized: DataFrame, weights: tuple[int, ...], share: float, most: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(rows, shares): the stored rows with `start`, the words of their source before them, and how much of them is taken; and the stored targets with blocks."""
    shares = stored(blocks(targets(sized.groupBy("key").agg(F.sum("size").alias("source_size")), weights, share, most), block), "targets")
    per_pass = F.ceil(F.col("source_size") / F.col("block"))
    got = F.least(F.coalesce("slots", F.lit(0)), per_pass * most)
    whole = F.when(per_pass > 0, F.floor(got / per_pass)).otherwise(0)
    plan = shares.join(slots_of(shares), "key", "left").select("key", "source_size", "target", "block", per_pass.alias("per_pass"), whole.alias("passes"), (got - whole * per_pass).alias("more"))
    sized = sized.withColumn("part", F.conv(F.substring("draw", 1, 2), 16, 10).cast("int"))
    placed = stored(_ranked(sized, "part", F.col("size"), ["draw", *[c for c in sized.columns if c in ("doc_id", "size", "h1", "h2")]], "start"), "placed")
    again = F.least(F.col("size"), F.greatest(F.lit(0), F.col("more") * F.col("block") - F.col("start")))
    taken = (F.col("passes") * F.col("size") + again).cast("long")
    copies = F.when(F.col("size") > 0, F.col("passes") + (F.floor(F.col("start") / F.col("block")) < F.col("more")).cast("long")).otherwise(0).cast("long")
    return placed.join(F.broadcast(plan), "key").withColumns({"taken": taken, "copies": copies}), shares


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, block: int = 16) -> DataFrame:
    """What the mix takes: doc_id, source, size, source_size, target, taken, copies (how often it starts in the mix).

    The words of a source stand in the order of md5(doc_id), cut into blocks of equal size (the
    last may be shorter): `block` words, fewer where a source's target is small. A null text has no
    words; a document without words is taken 0 times. A source's slots stop after `most` passes.
    Its slots rank 0, 1, 2, ... without gaps, so their number says how often each block is taken:
    whole passes over all blocks, and one more over the first ones. Repeated rows each count; a null
    source comes last, a null doc_id draws like an empty one. Of an empty table nothing is taken;
    other columns are ignored.
    """
    rows, _ = _planned(stored(_sizes(docs), "sized"), weights, share, most, block)
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


def take(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, block: int = 16) -> DataFrame:
    """The rows of docs as often as they start in the mix (see mix()), in the order of the slots in which they start.

    All columns come back, whatever their names. Rows that differ in any column are told apart by
    hashes of the text and of all columns; equal rows stand for each other. An empty table gives an empty one.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    h1, h2 = F.xxhash64(F.lit(1), F.col("text").cast("string")).alias("h1"), row_hash(docs, 2).alias("h2")
    rows, shares = _planned(stored(_sizes(docs, h1, h2), "sized"), weights, share, most, block)
    starts = rows.where("copies > 0").select("h1", "h2", "key", F.explode(F.transform(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int")), lambda p: (p * F.col("per_pass") + F.floor(F.col("start") / F.col("block"))).cast("long"))).alias("rank"))
    wanted = shares.select("key", (F.col("target") / F.col("block")).alias("target"))
    whole = float(wanted.agg(F.sum("target")).first()[0] or 0)
    slots = schedule(wanted, -int(-whole // 1)).select("slot", "key", F.col("rank").cast("long").alias("rank"))
    plan = stored(starts.join(slots, ["key", "rank"]).groupBy("h1", "h2").agg(F.sort_array(F.collect_list("slot")).alias("slots")), "plan")
    own = docs.select(F.struct(*columns).alias("row"), h1, h2).groupBy("h1", "h2").agg(F.first("row").alias("row")).join(plan, ["h1", "h2"])
    own = own.select("row", F.explode("slots").alias("slot")).repartitionByRange("slot").sortWithinPartitions("slot")
    return own.select("row.*")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """What a mix of 150% of all words by the weights 3, 1, 2 takes of each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES = {"op9_mixing": op9_mixing}
ORACLES = {
    "op9_mixing": r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS key, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents),
s AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size, CAST([3, 1, 2][(row_number() OVER (ORDER BY key = '', key) - 1) % 3 + 1] AS DOUBLE) AS weight FROM d GROUP BY key),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level FROM w
  WINDOW o AS (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT coalesce(arg_min(level, cap / weight) FILTER (level * weight < cap), 1e300) AS level FROM l),
t AS (SELECT key, source_size, least(cap, f.level * weight) AS target FROM l, f),
t2 AS (SELECT *, CAST(greatest(1, least(16, floor(target / 128))) AS BIGINT) AS block FROM t),
n AS (SELECT sum(target / block) AS whole FROM t2),
e AS (SELECT key, source_size, block, CAST(round(sum(target / block) OVER (ORDER BY key) / whole * 4294967296) AS BIGINT) AS hi FROM t2, n WHERE whole > 0),
e2 AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY key), 0) AS lo FROM e),
p AS (SELECT i, (i * 2654435769) % 4294967296 AS point FROM (SELECT unnest(range(CAST(ceil(whole) AS BIGINT))) AS i FROM n)),
r AS (SELECT key, block, row_number() OVER (PARTITION BY key ORDER BY i) - 1 AS rank, CAST(ceil(source_size / block) AS BIGINT) AS per_pass FROM p JOIN e2 ON point >= lo AND point < hi),
b AS (SELECT key, block, rank % per_pass AS b, count(*) AS times FROM r WHERE rank < 2 * per_pass GROUP BY ALL),
q AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY key ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d),
c AS (SELECT q.key, start, doc_id, size, sum((least(start + size, (b + 1) * block) - greatest(start, b * block)) * times) AS taken, sum(CASE WHEN start // block = b THEN times ELSE 0 END) AS copies
  FROM q JOIN b ON b.key = q.key AND b.b BETWEEN start // block AND (start + size - 1) // block WHERE size > 0 GROUP BY ALL)
SELECT q.doc_id, q.size, t.source_size, t.target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, CAST(coalesce(copies, 0) AS BIGINT) AS copies
FROM q JOIN t USING (key) LEFT JOIN c ON c.key = q.key AND c.start = q.start AND c.size = q.size""",
}
