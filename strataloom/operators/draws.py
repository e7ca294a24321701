"""Draws from counts: tables of cumulated shares, linear in the codes they hold, and the joins that look draws up.

The codes of one group (the rows with one code of the column drawn before) part [0, 1) by their
shares. Long groups are cut into buckets of equal width, and a draw meets only the codes that
reach into its own bucket, two of them on average, whatever the number of codes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.operators.ranks import ranked

#: The group of all rows; stands in for groups that are unknown or of which wishes leave nothing.
ANY = -2
#: Codes up to which a group is one bucket; codes a bucket else.
SHORT, EACH = 32, 8
#: Codes beyond which groups may be too long for one task: their sums are taken in ranges of codes.
LONG = 100_000
#: Bytes that a broadcast table of draws may take, by what the profile says of its size.
BROADCAST = 8 << 20


@dataclass(frozen=True)
class Shape:
    """What changes shares before a draw: probabilities wished for codes, temperature, nucleus."""

    wishes: tuple[tuple[int, float], ...] = ()
    diversity: float = 1.0
    cutoff: float = 1.0

    @staticmethod
    def of(wishes: dict[int, float], diversity: float = 1.0, cutoff: float = 1.0) -> Shape:
        return Shape(tuple(sorted(wishes.items())), diversity, cutoff)


def _with_sums(rows: DataFrame, long: bool, **sums: Column) -> DataFrame:
    """rows with aggregates of their groups: by windows, or, where groups are long, taken first and joined."""
    if not long:
        return rows.withColumns({k: v.over(Window.partitionBy("by")) for k, v in sums.items()})
    table = rows.groupBy(F.col("by").alias("_sby")).agg(*[v.alias(k) for k, v in sums.items()])
    return rows.join(table, F.col("by") == F.col("_sby")).drop("_sby")


def _with_before(rows: DataFrame, long: bool, name: str, order: list[str]) -> DataFrame:
    """rows with the sum of p over those before in their group: by a window, or, where groups are long, over ranges of all rows, less where the group begins."""
    if not long:
        own = Window.partitionBy("by").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(name, F.coalesce(F.sum("p").over(own), F.lit(0.0)))
    met = _with_sums(ranked(rows, ["by", *order], F.col("p"), "_before")[0], True, _begin=F.min("_before"))
    return met.withColumn(name, F.col("_before") - F.col("_begin")).drop("_before", "_begin")


def shares(counts: DataFrame, shape: Shape, long: bool = False) -> DataFrame:
    """(by, code, low, cum, many): the codes of each group with the part [low, cum) of [0, 1) that each one gets.

    counts: (by, code, n), the group ANY among them. Named codes get the probabilities wished for
    them, the others share the rest in proportion. A group of which nothing is left is left out,
    and so ANY stands in for it; if nothing is left of ANY, its wishes are dropped. long: whether a
    group may hold more codes than a task should.
    """
    rows = counts.select(F.col("by").cast("int").alias("by"), F.col("code").cast("int").alias("code"), (F.pow(F.col("n").cast("double"), F.lit(1 / shape.diversity)) if shape.diversity != 1 else F.col("n").cast("double")).alias("p"))
    if shape.cutoff < 1:
        rows = _with_sums(_with_before(rows.withColumn("_less", -F.col("p")), long, "ahead", ["_less", "code"]), long, whole=F.sum("p")).where(F.col("ahead") < shape.cutoff * F.col("whole") - 1e-12).select("by", "code", "p")
    if shape.wishes:
        wished = {c: float(v) for c, v in shape.wishes}
        more = [F.lit(c) for c, v in wished.items() if v > 0]
        if more:
            rows = rows.union(rows.select("by").distinct().select("by", F.explode(F.array(*more)).alias("code"), F.lit(0.0).alias("p"))).groupBy("by", "code").agg(F.max("p").alias("p"))
        wish = F.try_element_at(F.create_map(*[F.lit(x) for kv in wished.items() for x in kv]), F.col("code"))
        rows = rows.withColumn("wish", wish)
        rows = _with_sums(rows, long, free=F.sum(F.when(F.col("wish").isNull(), F.col("p")))).fillna(0.0, "free")
        left = max(0.0, 1 - sum(wished.values()))
        # counts stay whole where codes are only left out: sums of rounded parts would move the limits of many codes
        rest = F.col("p") / F.col("free") * left if more else F.col("p")
        rows = rows.withColumn("q", F.coalesce("wish", F.when(F.col("free") > 0, rest), F.lit(0.0)))
        rows = _with_sums(rows, long, all=F.sum("q")).withColumn("some", F.col("all") > 0).select("by", "code", F.when(F.col("some"), F.col("q")).when(F.col("by") == ANY, F.col("p")).alias("p"))
    rows = rows.where("p > 0")
    if long:
        rows = _with_sums(_with_before(rows, long, "before", ["code"]), long, whole=F.sum("p"), last=F.max("code"), many=F.count("*"))
        cum = F.when(F.col("code") == F.col("last"), 1.0).otherwise((F.col("before") + F.col("p")) / F.col("whole"))
        return rows.select("by", "code", (F.col("before") / F.col("whole")).alias("low"), cum.alias("cum"), "many")
    own = Window.partitionBy("by")
    upto = F.sum("p").over(own.orderBy("code").rowsBetween(Window.unboundedPreceding, Window.currentRow)) / F.sum("p").over(own)
    rows = rows.select("by", "code", upto.alias("upto"), F.count("*").over(own).alias("many"))
    at = own.orderBy("code")
    return rows.select("by", "code", F.coalesce(F.lag("upto").over(at), F.lit(0.0)).alias("low"), F.when(F.lead("code").over(at).isNull(), 1.0).otherwise(F.col("upto")).alias("cum"), "many")


def _slots(rows: DataFrame) -> DataFrame:
    """(by, buckets, bucket, slots): the (cum, code) of each bucket in order."""
    n = F.when(F.col("many") <= SHORT, 1).otherwise(F.ceil(F.col("many") / EACH)).cast("int")
    last = F.col("buckets") - 1
    at = lambda c: F.least(F.floor(F.col(c) * F.col("buckets")).cast("int"), last)
    rows = rows.withColumn("buckets", n).withColumn("bucket", F.explode(F.sequence(at("low"), at("cum"))))
    return rows.groupBy("by", "buckets", "bucket").agg(F.sort_array(F.collect_list(F.struct("cum", "code"))).alias("slots"))


def _first(u: Column, slots: Column) -> Column:
    """The first code whose cumulated share exceeds u."""
    return F.get(F.filter(slots, lambda x: x.cum > u), F.lit(0)).code


def drawn(rows: DataFrame, name: str, u: Column, counts: DataFrame, shape: Shape, codes: int, by: Column | None = None, groups: int = 1) -> DataFrame:
    """rows with `name`: a code for the uniform number u, drawn from the shares of the group `by`, or of ANY.

    counts: (by, code, n); codes, groups: how many different ones there can be at most, by the
    profile, by which the tables are known to be small enough to be broadcast, or joined if not.
    No counts at all give code 0.
    """
    slots = _slots(shares(counts, shape, codes > LONG))
    rows = rows.withColumn("_du", u)
    if codes <= SHORT:
        small = slots.select("by", "slots")
        anyone = small.where(F.col("by") == ANY).select(F.lit(1).alias("_dkey"), F.col("slots").alias("_dany"))
        rows = rows.withColumn("_dkey", F.lit(1)).join(F.broadcast(anyone), "_dkey", "left")  # one row
        table = F.col("_dany")
        if by is not None:
            small = small.where(F.col("by") != ANY).select(F.col("by").alias("_dby"), F.col("slots").alias("_down"))
            rows = rows.withColumn("_dof", by).join(F.broadcast(small) if groups * codes * 24 <= BROADCAST else small, F.col("_dof") == F.col("_dby"), "left")
            table = F.coalesce("_down", "_dany")
        out = rows.withColumn("_drawn", F.coalesce(_first(F.col("_du"), table), F.lit(0)))
        return out.drop("_du", "_dkey", "_dany", "_dof", "_dby", "_down", *([name] if name in rows.columns else [])).withColumnRenamed("_drawn", name)
    heads = slots.select("by", "buckets").distinct()
    anyone = heads.where(F.col("by") == ANY).select(F.lit(1).alias("_dkey"), F.col("buckets").alias("_dmany"))
    rows = rows.withColumn("_dkey", F.lit(1)).join(F.broadcast(anyone), "_dkey", "left")  # one row
    use, many = F.lit(ANY), F.col("_dmany")
    if by is not None:
        own = heads.where(F.col("by") != ANY).select(F.col("by").alias("_dby"), F.col("buckets").alias("_dbuckets"))
        rows = rows.withColumn("_dof", by).join(F.broadcast(own) if groups * 16 <= BROADCAST else own, F.col("_dof") == F.col("_dby"), "left")
        use, many = F.coalesce("_dby", F.lit(ANY)), F.coalesce("_dbuckets", "_dmany")
    rows = rows.withColumns({"_duse": use, "_dbucket": F.least(F.floor(F.col("_du") * many).cast("int"), many - 1)})
    table = slots.select(F.col("by").alias("_dsby"), F.col("bucket").alias("_dsb"), F.col("slots").alias("_dslots"))
    met = rows.join(F.broadcast(table) if groups * codes * 48 <= BROADCAST else table, (F.col("_duse") == F.col("_dsby")) & (F.col("_dbucket") == F.col("_dsb")), "left")
    out = met.withColumn("_drawn", F.coalesce(_first(F.col("_du"), F.col("_dslots")), F.lit(0)))
    return out.drop("_du", "_dkey", "_dmany", "_dof", "_dby", "_dbuckets", "_duse", "_dbucket", "_dsby", "_dsb", "_dslots", *([name] if name in rows.columns else [])).withColumnRenamed("_drawn", name)

