"""Registered queries over the test tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.config import Bias, Distribution, Privacy, resolve_config
from strataloom.functions import values as V
from strataloom.functions.rng import laplace, normal, uniform
from strataloom.operators import constraints as C
from strataloom.operators import encode as E
from strataloom.operators import profile as P
from strataloom.operators import sampler as M
from strataloom.operators import sequences as S
from strataloom.operators import tables as T
from strataloom.operators.decode import decode_columns
from strataloom.operators.embedding import LinearEncoder, TableEncoder, context_vectors, embed, project, told_codes, with_context_vectors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
PINNED = Privacy(threshold=5)


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function, with its SQL if SQL can express it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _u(seed: int, *keys: str) -> str:
    """uniform() as SQL."""
    return f"(CAST('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)})), 1, 13) AS BIGINT) / 4503599627370496.0)"


def _holed(spark: SparkSession, d: str) -> DataFrame:
    """orders with a tenth of the priorities and prices null, by a hash."""
    o = _t(spark, d, "orders")
    gone = lambda c, k: F.when(uniform(k, "o_orderkey") >= 0.1, F.col(c)).alias(c)
    return o.select("o_orderkey", "o_custkey", gone("o_orderpriority", 1), gone("o_totalprice", 2), "o_orderdate")


_HOLED = f"""WITH h AS (SELECT o_orderkey, o_custkey, CASE WHEN {_u(1, "o_orderkey")} >= 0.1 THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN {_u(2, "o_orderkey")} >= 0.1 THEN o_totalprice END AS o_totalprice, o_orderdate FROM orders)"""


# profiles of categories


@register("SELECT c_mktsegment AS value, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def cat_profile(spark: SparkSession, d: str) -> DataFrame:
    return P.category_counts(_t(spark, d, "customer"), F.col("c_mktsegment"))


@register("SELECT event_type AS value, count(DISTINCT user_id) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def cat_profile_by_root(spark: SparkSession, d: str) -> DataFrame:
    return P.category_counts(_t(spark, d, "events"), F.col("event_type"), F.col("user_id"))


@register("""WITH k AS (SELECT c_mktsegment AS value FROM customer GROUP BY 1 HAVING count(*) >= 5 AND value IS NOT NULL)
SELECT value, CAST(row_number() OVER (ORDER BY value) AS INTEGER) AS code FROM k UNION ALL SELECT '<protected>', 0""")
def cat_vocab_codes(spark: SparkSession, d: str) -> DataFrame:
    return P.vocabulary(P.category_counts(_t(spark, d, "customer"), F.col("c_mktsegment")), 5, False)


@register(_HOLED + """, k AS (SELECT o_orderpriority AS value FROM h WHERE o_orderpriority IS NOT NULL GROUP BY 1 HAVING count(*) >= 5)
SELECT value, CAST(row_number() OVER (ORDER BY value) + 1 AS INTEGER) AS code FROM k UNION ALL SELECT '<protected>', 0 UNION ALL SELECT '<<NULL>>', 1""")
def cat_vocab_nulls(spark: SparkSession, d: str) -> DataFrame:
    return P.vocabulary(P.category_counts(_holed(spark, d), F.col("o_orderpriority")), 5, True)


@register("SELECT p_name AS value, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY 1 HAVING count(*) >= 3")
def cat_rare_filter(spark: SparkSession, d: str) -> DataFrame:
    return P.category_counts(_t(spark, d, "part"), F.col("p_name")).where("n >= 3")


_VOCAB = """k AS (SELECT {c} AS value FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) >= 5),
v AS (SELECT value, CAST(row_number() OVER (ORDER BY value) + {s} AS INTEGER) AS code FROM k)"""


@register(_HOLED + ", " + _VOCAB.format(c="o_orderpriority", t="h", s=1) + " SELECT o_orderkey, CASE WHEN o_orderpriority IS NULL THEN 1 ELSE coalesce(code, 0) END AS o_orderpriority__cat FROM h LEFT JOIN v ON value = o_orderpriority")
def cat_encode(spark: SparkSession, d: str) -> DataFrame:
    rows = _holed(spark, d).select("o_orderkey", "o_orderpriority")
    return E.encode_columns(rows, P.profile_table(rows.drop("o_orderkey"), privacy=PINNED), ("o_orderkey",))


@register("WITH " + _VOCAB.format(c="p_type", t="part", s=0) + " SELECT p_partkey, coalesce(code, 0) AS code FROM part LEFT JOIN v ON value = p_type")
def cat_encode_join(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "part").select("p_partkey", "p_type")
    return E.encode_by_join(rows, "p_type", P.vocabulary(P.category_counts(rows, F.col("p_type")), 5, False), False).select("p_partkey", "code")


@register("WITH " + _VOCAB.format(c="p_type", t="part", s=0) + " SELECT p_partkey, CASE WHEN value IS NULL THEN '<protected>' ELSE p_type END AS p_type FROM part LEFT JOIN v ON value = p_type")
def cat_decode_mask(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "part").select("p_partkey", "p_type")
    p = P.profile_table(rows.drop("p_partkey"), {"p_type": "categorical"}, PINNED)
    return decode_columns(E.encode_columns(rows, p, ("p_partkey",)), p, "mask", 7, "p_partkey", ("p_partkey",))


@register("WITH " + _VOCAB.format(c="p_type", t="part", s=0) + f""", n AS (SELECT count(*) AS n FROM v)
SELECT p_partkey, coalesce(v.value, w.value) AS p_type FROM part CROSS JOIN n LEFT JOIN v ON v.value = p_type
LEFT JOIN v w ON w.code = 1 + CAST(floor({_u(7, "'p_type'", "'rare'", "p_partkey")} * n) AS INTEGER)""")
def cat_decode_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "part").select("p_partkey", "p_type")
    p = P.profile_table(rows.drop("p_partkey"), {"p_type": "categorical"}, PINNED)
    return decode_columns(E.encode_columns(rows, p, ("p_partkey",)), p, "sample", 7, "p_partkey", ("p_partkey",))


# numbers


@register(_HOLED + """ SELECT count(o_totalprice) AS n, count(*) FILTER (o_totalprice IS NULL) AS n_null, count(DISTINCT o_totalprice) AS n_distinct,
  min(o_totalprice) AS low, max(o_totalprice) AS high, coalesce(bool_or(o_totalprice < 0), false) AS has_neg,
  CASE WHEN bool_or(round(o_totalprice * 100) % 10 <> 0) THEN -2 WHEN bool_or(round(o_totalprice * 10) % 10 <> 0) THEN -1 ELSE 0 END AS min_digit,
  CAST(floor(log10(max(abs(o_totalprice)))) AS INTEGER) AS max_digit FROM h""")
def num_profile(spark: SparkSession, d: str) -> DataFrame:
    return P.numeric_ranges(_holed(spark, d), F.col("o_totalprice"))


@register("""SELECT (SELECT o_totalprice FROM orders ORDER BY 1 LIMIT 1 OFFSET 5) AS low, (SELECT o_totalprice FROM orders ORDER BY 1 DESC LIMIT 1 OFFSET 5) AS high""")
def num_bounds_kth(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([P.kth_extremes(_t(spark, d, "orders"), F.col("o_totalprice"), 5)], "low double, high double")


_PROBE = """WITH r AS (SELECT {c} AS x, row_number() OVER (ORDER BY {c}) - 1 AS k, count(*) OVER () AS n FROM {t} WHERE {c} IS NOT NULL),
p AS (SELECT i, (SELECT max(n) FROM r) * (i / {m}.0) - 1.5 AS h FROM range({m} + 1) g(i)),
a AS (SELECT i, least(greatest(CASE WHEN h = floor(h) AND CAST(floor(h) AS BIGINT) % 2 <> 0 THEN floor(h) ELSE floor(h) + 1 END, 0), (SELECT max(n) FROM r) - 1) AS k FROM p)"""


@register(_PROBE.format(c="o_totalprice", t="orders", m=100) + " SELECT CAST(i AS INTEGER) AS i, x FROM a JOIN r USING (k)")
def num_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return P.quantiles(_t(spark, d, "orders"), F.col("o_totalprice"), 101)


def _bins(spark: SparkSession, d: str):
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rows, P.profile_table(rows.select("l_quantity"), {"l_quantity": "numeric_binned"}, PINNED)


@register("""WITH b AS (SELECT (SELECT l_quantity FROM lineitem ORDER BY 1 LIMIT 1 OFFSET 5) AS lo, (SELECT l_quantity FROM lineitem ORDER BY 1 DESC LIMIT 1 OFFSET 5) AS hi),
e AS (SELECT DISTINCT least(greatest(l_quantity, lo), hi) AS x FROM lineitem, b),
c AS (SELECT l_orderkey, l_linenumber, l_quantity, (SELECT count(*) FROM e WHERE x <= l_quantity) AS below, (SELECT count(*) FROM e) AS m, lo, hi FROM lineitem, b)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_quantity = lo THEN 1 WHEN l_quantity = hi THEN 2 ELSE 3 + least(greatest(below - 1, 0), m - 2) END AS INTEGER) AS l_quantity__bin FROM c""")
def num_bins_encode(spark: SparkSession, d: str) -> DataFrame:
    rows, p = _bins(spark, d)
    return E.encode_columns(rows, p, ("l_orderkey", "l_linenumber"))


@register(_PROBE.format(c="o_totalprice", t="orders", m=1000) + """, b AS (SELECT (SELECT o_totalprice FROM orders ORDER BY 1 LIMIT 1 OFFSET 5) AS lo, (SELECT o_totalprice FROM orders ORDER BY 1 DESC LIMIT 1 OFFSET 5) AS hi),
q AS (SELECT row_number() OVER (ORDER BY i) - 1 AS pos, least(greatest(x, lo), hi) AS x FROM a JOIN r USING (k), b),
g AS (SELECT i, 1001 * (i / 100.0) - 1.5 AS h FROM range(101) g(i)),
e AS (SELECT DISTINCT x FROM q JOIN g ON pos = least(greatest(CASE WHEN h = floor(h) AND CAST(floor(h) AS BIGINT) % 2 <> 0 THEN floor(h) ELSE floor(h) + 1 END, 0), 1000)),
c AS (SELECT o_orderkey, o_totalprice AS v, (SELECT count(*) FROM e WHERE x <= o_totalprice) AS below, (SELECT count(*) FROM e) AS m, lo, hi FROM orders, b)
SELECT o_orderkey, CAST(CASE WHEN v = lo THEN 1 WHEN v = hi THEN 2 ELSE 3 + least(greatest(below - 1, 0), m - 2) END AS INTEGER) AS o_totalprice__bin FROM c""")
def num_bins_many(spark: SparkSession, d: str) -> DataFrame:
    """Bins of a column with many distinct values, by quantiles of quantiles."""
    rows = _t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return E.encode_columns(rows, P.profile_table(rows.select("o_totalprice"), {"o_totalprice": "numeric_binned"}, PINNED), ("o_orderkey",))


@register(_HOLED + f""", s AS (SELECT o_totalprice AS x, row_number() OVER (ORDER BY o_totalprice) - 1 AS k, count(*) OVER () AS n FROM h WHERE o_totalprice IS NOT NULL),
p AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice IS NULL THEN CAST(floor({_u(5, "'o_totalprice'", "o_orderkey")} * (SELECT max(n) FROM s)) AS BIGINT) END AS k FROM h)
SELECT o_orderkey, coalesce(o_totalprice, x) AS o_totalprice FROM p LEFT JOIN s USING (k)""")
def fill_missing(spark: SparkSession, d: str) -> DataFrame:
    return E.fill_missing(_holed(spark, d).select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 5)


@register(_HOLED + f""", s AS (SELECT o_totalprice AS x, row_number() OVER (ORDER BY o_totalprice) - 1 AS k, count(*) OVER () AS n FROM h WHERE o_totalprice IS NOT NULL),
p AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice IS NULL THEN CAST(floor({_u(5, "'o_totalprice'", "o_orderkey")} * (SELECT max(n) FROM s)) AS BIGINT) END AS k FROM h),
b AS (SELECT (SELECT o_totalprice FROM h WHERE o_totalprice IS NOT NULL ORDER BY 1 LIMIT 1 OFFSET 5) AS lo, (SELECT o_totalprice FROM h WHERE o_totalprice IS NOT NULL ORDER BY 1 DESC LIMIT 1 OFFSET 5) AS hi)
SELECT o_orderkey, CAST(o_totalprice IS NULL AS INTEGER) AS gone, round(least(greatest(coalesce(o_totalprice, x), lo), hi), 2) AS o_totalprice FROM p LEFT JOIN s USING (k), b""")
def num_digit_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Digits of nulls are those of values drawn from the other rows."""
    rows = _holed(spark, d).select("o_orderkey", "o_totalprice")
    p = P.profile_table(rows.select("o_totalprice"), {"o_totalprice": "numeric_digit"}, PINNED)
    codes = E.encode_columns(rows, p, ("o_orderkey",), 5, "o_orderkey").withColumnRenamed("o_totalprice__nan", "gone").withColumn("o_totalprice__nan", F.lit(0))
    return decode_columns(codes, p, row="o_orderkey", keep=("o_orderkey", "gone")).withColumn("o_totalprice", F.round("o_totalprice", 2))


@register("SELECT count(*) AS n, CAST(0 AS BIGINT) AS outside FROM lineitem")
def num_bins_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows, p = _bins(spark, d)
    rows = rows.withColumn("row_id", F.concat_ws("|", "l_orderkey", "l_linenumber"))
    back = decode_columns(E.encode_columns(rows, p, ("row_id", "l_quantity")), p, "mask", 3, "row_id", ("l_quantity",)).toDF("was", "now")
    return back.agg(F.count("*").alias("n"), F.count(F.when(F.abs(F.col("was") - F.col("now")) > 1, 1)).alias("outside"))


@register("""WITH k AS (SELECT p_size AS v FROM part GROUP BY 1 HAVING count(*) >= 5), c AS (SELECT v, row_number() OVER (ORDER BY CAST(v AS VARCHAR)) AS code FROM k)
SELECT p_partkey, CAST(coalesce(code, 0) AS INTEGER) AS p_size__cat FROM part LEFT JOIN c ON v = p_size""")
def num_discrete_encode(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "part").select("p_partkey", "p_size")
    return E.encode_columns(rows, P.profile_table(rows.select("p_size"), privacy=PINNED), ("p_partkey",))


@register("""SELECT c_custkey, lpad(replace(CAST(CAST(abs(c_acctbal) AS DECIMAL(27, 8)) AS VARCHAR), '.', ''), 27, '0') AS digits,
  CAST(floor(abs(c_acctbal)) % 10 AS INTEGER) AS units, CAST(round(abs(c_acctbal) * 100) % 10 AS INTEGER) AS cents, c_acctbal < 0 AS neg FROM customer""")
def num_digits(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_acctbal")
    return _t(spark, d, "customer").select("c_custkey", V.digit_text(c).alias("digits"), V.digit(c, 0).alias("units"), V.digit(c, -2).alias("cents"), (c < 0).alias("neg"))


@register("""WITH b AS (SELECT (SELECT c_acctbal FROM customer ORDER BY 1 LIMIT 1 OFFSET 5) AS lo, (SELECT c_acctbal FROM customer ORDER BY 1 DESC LIMIT 1 OFFSET 5) AS hi)
SELECT c_custkey, round(least(greatest(c_acctbal, lo), hi), 2) AS c_acctbal FROM customer, b""")
def num_digit_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "customer").select("c_custkey", "c_acctbal")
    p = P.profile_table(rows.select("c_acctbal"), {"c_acctbal": "numeric_digit"}, PINNED)
    return decode_columns(E.encode_columns(rows, p, ("c_custkey",)), p, row="c_custkey", keep=("c_custkey",)).withColumn("c_acctbal", F.round("c_acctbal", 2))


@register("""SELECT CAST(CASE WHEN x >= 1 THEN 65 + floor(log2(x)) WHEN x >= 0 THEN 64 WHEN x >= -1 THEN 63 ELSE 63 - ceil(log2(-x)) END AS INTEGER) AS bucket, count(*) AS n
FROM (SELECT c_acctbal AS x FROM customer) GROUP BY 1""")
def num_log_hist(spark: SparkSession, d: str) -> DataFrame:
    return P.log_histogram(_t(spark, d, "customer"), F.col("c_acctbal"))


_DP = [1e-8 * 10**k for k in range(6)]


@register("""WITH h AS (SELECT CAST(CASE WHEN x >= 1 THEN 65 + floor(log2(x)) WHEN x >= 0 THEN 64 ELSE 63 END AS INTEGER) AS bucket, count(*) AS n FROM (SELECT o_totalprice AS x FROM orders) GROUP BY 1),
b AS (SELECT CAST(i AS INTEGER) AS bucket FROM range(128) g(i)), """ + f"""n AS (SELECT bucket, coalesce(n, 0) - 1.0 * sign({_u(11, 'bucket')} - 0.5) * ln(greatest(1 - 2 * abs({_u(11, 'bucket')} - 0.5), 1e-300)) AS n FROM b LEFT JOIN h USING (bucket)),
k AS (SELECT * FROM (VALUES {', '.join(f'({i}, CAST(-ln(2 - 2 * pow(CAST({1 - c!r} AS DOUBLE), 1 / 127.0::DOUBLE)) AS DOUBLE))' for i, c in enumerate(_DP))}) v(i, least)),
o AS (SELECT i, min(bucket) AS lo, max(bucket) AS hi FROM n JOIN k ON n > least GROUP BY i ORDER BY i LIMIT 1)
SELECT pow(2.0, lo - 65) AS low, pow(2.0, hi - 64) AS high FROM o""")
def dp_bounds(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([P.dp_bounds(_t(spark, d, "orders"), F.col("o_totalprice"), 1.0, 11)], "low double, high double")


@register(f"""WITH c AS (SELECT p_name AS value, count(*) AS n FROM part GROUP BY 1), u AS (SELECT value, n, {_u(11, "value")} - 0.5 AS c FROM c)
SELECT value, round(n - 1.0 * sign(c) * ln(greatest(1 - 2 * abs(c), 1e-300)), 6) AS n FROM u WHERE n - 1.0 * sign(c) * ln(greatest(1 - 2 * abs(c), 1e-300)) >= 5""")
def dp_value_filter(spark: SparkSession, d: str) -> DataFrame:
    return P.dp_counts(P.category_counts(_t(spark, d, "part"), F.col("p_name")), 1.0, 11).withColumn("n", F.round("n", 6))


# dates


@register("""SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
  CAST(second(ts) AS INTEGER) AS second, CAST(epoch_us(ts) % 1000000 // 100000 % 10 AS INTEGER) AS ms_E2, CAST(epoch_us(ts) % 1000000 // 10000 % 10 AS INTEGER) AS ms_E1, CAST(epoch_us(ts) % 1000000 // 1000 % 10 AS INTEGER) AS ms_E0 FROM events""")
def dt_split(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select("event_id", *[c.alias(k) for k, c in V.datetime_parts(F.col("ts")).items()])


_PARTS = ["year", "month", "day", "hour", "minute", "second"]


@register("SELECT count(*) AS n, " + ", ".join(f"CAST({f}({p}(ts)) AS INTEGER) AS {p}_{f}" for p in _PARTS for f in ("min", "max")) + " FROM events WHERE ts IS NOT NULL")
def dt_profile(spark: SparkSession, d: str) -> DataFrame:
    return P.datetime_ranges(_t(spark, d, "events"), F.col("ts")).select("n", *[f"{p}_{f}" for p in _PARTS for f in ("min", "max")])


def _dates(spark: SparkSession, d: str):
    rows = _t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return rows, P.profile_table(rows.select("o_orderdate"), privacy=PINNED)


_BOUNDED = """WITH b AS (SELECT (SELECT o_orderdate FROM orders ORDER BY 1 LIMIT 1 OFFSET 5) AS lo, (SELECT o_orderdate FROM orders ORDER BY 1 DESC LIMIT 1 OFFSET 5) AS hi),
c AS (SELECT o_orderkey, least(greatest(o_orderdate, lo), hi) AS t, lo, hi FROM orders, b)"""


@register(_BOUNDED + """ SELECT o_orderkey, CAST(year(t) - year(lo) AS INTEGER) AS o_orderdate__year, CAST(month(t) - (SELECT min(month(o_orderdate)) FROM orders) AS INTEGER) AS o_orderdate__month,
  CAST(day(t) - (SELECT min(day(o_orderdate)) FROM orders) AS INTEGER) AS o_orderdate__day FROM c""")
def dt_encode(spark: SparkSession, d: str) -> DataFrame:
    rows, p = _dates(spark, d)
    return E.encode_columns(rows, p, ("o_orderkey",)).select("o_orderkey", *[f"o_orderdate__{k}" for k in ("year", "month", "day")])


@register(_BOUNDED + " SELECT o_orderkey, date_trunc('second', t) AS o_orderdate FROM c")
def dt_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows, p = _dates(spark, d)
    back = decode_columns(E.encode_columns(rows, p, ("o_orderkey",)), p, row="o_orderkey", keep=("o_orderkey",))
    return back.withColumn("o_orderdate", F.date_trunc("second", "o_orderdate").cast("timestamp_ntz"))


@register("""SELECT o_orderkey, CAST(least(1 + o_orderkey % 31, day(last_day(o_orderdate))) AS INTEGER) AS day,
  make_date(year(o_orderdate), month(o_orderdate), least(1 + o_orderkey % 31, day(last_day(o_orderdate))))::TIMESTAMP AS t FROM orders""")
def dt_clip_day(spark: SparkSession, d: str) -> DataFrame:
    """Days that go beyond the ends of the orders' months, and the dates assembled from them."""
    year, month, day = F.year("o_orderdate"), F.month("o_orderdate"), (1 + F.col("o_orderkey") % 31).cast("int")
    made = V.assembled_datetime({"year": year, "month": month, "day": day})
    return _t(spark, d, "orders").select("o_orderkey", V.clipped_day(year, month, day).alias("day"), made.cast("timestamp_ntz").alias("t"))


@register("SELECT event_id, date_trunc('day', ts) AS day_first, CASE WHEN event_id % 9 > 0 THEN date_trunc('day', ts) END AS month_first FROM events")
def dt_day_first(spark: SparkSession, d: str) -> DataFrame:
    """Two columns of dates with slashes: the order of day and month is that by which fewer texts of the column are lost."""
    said = _t(spark, d, "events").select("event_id", F.date_format("ts", "dd/MM/yyyy").alias("a"), F.when(F.col("event_id") % 9 > 0, F.date_format("ts", "MM/dd/yyyy")).otherwise("?").alias("b"))
    first = said.agg(*[(V.day_first_share(F.col(c)) > 0).alias(c) for c in "ab"]).first()
    return said.select("event_id", *[V.to_datetime(F.col(c), first[c]).cast("timestamp_ntz").alias(k) for c, k in (("a", "day_first"), ("b", "month_first"))])


@register("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('day', ts) END AS t FROM events""")
def dt_parse(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events")
    said = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "MM/dd/yyyy")).otherwise("not a date")
    return e.select("event_id", V.to_datetime(said).cast("timestamp_ntz").alias("t"))


# characters and text


@register("SELECT c_custkey, " + ", ".join(f"CASE WHEN length(c_name) > {i} THEN c_name[{i + 1}] ELSE '-' END AS p{i}" for i in (0, 8, 17, 20)) + " FROM customer")
def char_split(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_name")
    return _t(spark, d, "customer").select("c_custkey", *[F.when(V.char_at(c, i) == V.PAD, "-").otherwise(V.char_at(c, i)).alias(f"p{i}") for i in (0, 8, 17, 20)])


@register("""SELECT CAST(pos AS INTEGER) AS pos, c_name[pos + 1] AS ch, count(*) AS n FROM customer, range(50) g(pos) WHERE pos < length(c_name) GROUP BY 1, 2""")
def char_profile(spark: SparkSession, d: str) -> DataFrame:
    return P.char_counts(_t(spark, d, "customer"), F.col("c_name"))


@register("""WITH c AS (SELECT p_partkey, pos, p_brand[pos + 1] AS ch FROM part, range(50) g(pos) WHERE pos < length(p_brand)), k AS (SELECT pos, ch AS kept FROM c GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT p_partkey, rtrim(string_agg(coalesce(kept, ''), '' ORDER BY c.pos)) AS p_brand FROM c LEFT JOIN k ON k.pos = c.pos AND kept = ch GROUP BY 1""")
def char_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "part").select("p_partkey", "p_brand")
    p = P.profile_table(rows.select("p_brand"), {"p_brand": "character"}, PINNED)
    return decode_columns(E.encode_columns(rows, p, ("p_partkey",)), p, row="p_partkey", keep=("p_partkey",))


@register(r"SELECT event_id, TRY_CAST(nullif(regexp_extract(props, '(-?[0-9]*[\.]?[0-9]+(?:[eE][+\-]?\d+)?)', 1), '') AS DOUBLE) AS x FROM events")
def str_to_num(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select("event_id", V.to_number(F.col("props")).alias("x"))


@register("""WITH s AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '<protected>' WHEN 1 THEN '<<NULL>>' WHEN 2 THEN chr(1) || p_name ELSE p_name END AS x FROM part)
SELECT p_partkey, x, CASE WHEN p_partkey % 4 = 3 THEN x ELSE chr(1) || x END AS coded FROM s""")
def str_escape(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    x = F.when(k == 0, V.RARE).when(k == 1, V.NULL).when(k == 2, F.concat(F.lit(V.ESCAPE), "p_name")).otherwise(F.col("p_name"))
    return _t(spark, d, "part").select("p_partkey", V.unescape_tokens(V.escape_tokens(x)).alias("x"), V.escape_tokens(x).alias("coded"))


@register("""SELECT 'p_partkey' AS feature, CASE WHEN count(DISTINCT p_partkey) <= 100 THEN 'numeric_discrete' ELSE 'numeric_binned' END AS encoding FROM part
UNION ALL SELECT 'p_name', CASE WHEN count(DISTINCT p_name) > 100 AND avg(length(p_name)) < 20 THEN 'character' ELSE 'categorical' END FROM part
UNION ALL SELECT 'p_brand', CASE WHEN count(DISTINCT p_brand) > 100 AND avg(length(p_brand)) < 20 THEN 'character' ELSE 'categorical' END FROM part
UNION ALL SELECT 'p_type', CASE WHEN count(DISTINCT p_type) > 100 AND avg(length(p_type)) < 20 THEN 'character' ELSE 'categorical' END FROM part
UNION ALL SELECT 'p_size', CASE WHEN count(DISTINCT p_size) <= 100 THEN 'numeric_discrete' ELSE 'numeric_binned' END FROM part
UNION ALL SELECT 'p_retailprice', CASE WHEN count(DISTINCT p_retailprice) <= 20 THEN 'categorical' ELSE 'numeric_binned' END FROM part""")
def type_inference(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([*P.infer_types(_t(spark, d, "part")).items()], "feature string, encoding string")


# priors and counts


@register("""WITH v AS (SELECT o_orderpriority AS value, CAST(row_number() OVER (ORDER BY o_orderpriority) AS INTEGER) AS code, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 5)
SELECT code, (n + 1) / (SELECT count(*) + (SELECT count(*) + 1 FROM v) FROM orders)::DOUBLE AS p FROM v
UNION ALL SELECT 0, (1 + (SELECT count(*) FROM orders WHERE o_orderpriority NOT IN (SELECT value FROM v))) / (SELECT count(*) + (SELECT count(*) + 1 FROM v) FROM orders)::DOUBLE""")
def priors(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "orders").select("o_orderpriority")
    p = P.profile_table(rows, privacy=PINNED)
    return P.priors(E.encode_columns(rows, p), "o_orderpriority__cat", p.columns["o_orderpriority"].subs["cat"])


def _bounds_sql(column: str, value: str) -> str:
    """The profile_many row of a number: the fifth value from each end, counted from 0."""
    return f"""SELECT '{column}' AS name, 0::BIGINT AS codes, 0::BIGINT AS rare, bool_or({column} IS NULL) AS has_null,
      (SELECT {value} FROM h WHERE {column} IS NOT NULL ORDER BY 1 LIMIT 1 OFFSET 5)::DOUBLE AS low, (SELECT {value} FROM h WHERE {column} IS NOT NULL ORDER BY 1 DESC LIMIT 1 OFFSET 5)::DOUBLE AS high FROM h"""


def _labels_sql(column: str) -> str:
    """The profile_many row of a category."""
    return f"""SELECT '{column}' AS name, 1 + (SELECT max(CAST({column} IS NULL AS BIGINT)) FROM h) + count(*) FILTER (n >= 5) AS codes, count(*) FILTER (n < 5) AS rare, (SELECT bool_or({column} IS NULL) FROM h) AS has_null,
      NULL::DOUBLE AS low, NULL::DOUBLE AS high FROM (SELECT {column}, count(*) AS n FROM h WHERE {column} IS NOT NULL GROUP BY 1)"""


_MANY = {"o_custkey": "categorical", "o_orderpriority": "categorical", "o_orderkey": "numeric_binned", "o_totalprice": "numeric_digit", "o_orderdate": "datetime"}


@register(_HOLED + " " + " UNION ALL ".join(_labels_sql(c) if e == "categorical" else _bounds_sql(c, f"epoch_us({c})" if e == "datetime" else c) for c, e in _MANY.items()))
def profile_many(spark: SparkSession, d: str) -> DataFrame:
    """One row about each column of orders with gaps, from a profile that counts the values of all columns together."""
    columns = P.profile_table(_holed(spark, d), _MANY, PINNED).columns.values()
    rows = [(c.name, c.n_labels, c.rare, c.has_null, *(map(float, c.bounds) if c.bounds else (None, None))) for c in columns]
    return spark.createDataFrame(rows, "name string, codes long, rare long, has_null boolean, low double, high double")


@register("SELECT c_nationkey AS a, c_mktsegment AS b, count(*) AS n FROM customer GROUP BY 1, 2")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.pair_counts(_t(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("a"), F.col("c_mktsegment").alias("b")), ["a", "b"]).where("i = 0 and j = 1").select(F.col("a").cast("int").alias("a"), "b", "n")


@register(_HOLED + " SELECT max(CAST(o_orderpriority IS NULL AS INTEGER)) AS o_orderpriority, max(CAST(o_totalprice IS NULL AS INTEGER)) AS o_totalprice, max(CAST(o_custkey IS NULL AS INTEGER)) AS o_custkey FROM h")
def null_masks(spark: SparkSession, d: str) -> DataFrame:
    names = P.null_columns(_holed(spark, d))
    return spark.createDataFrame([tuple(int(c in names) for c in ("o_orderpriority", "o_totalprice", "o_custkey"))], "o_orderpriority int, o_totalprice int, o_custkey int")


# sequences


@register("WITH s AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1) SELECT count(*) AS entities, max(n) AS longest, CAST(floor(median(n)) AS BIGINT) AS median FROM s")
def seq_len_stats(spark: SparkSession, d: str) -> DataFrame:
    return S.length_stats(_t(spark, d, "events"), "user_id")


@register("""WITH r AS (SELECT user_id, ts, event_id, value FROM events UNION ALL SELECT DISTINCT user_id, NULL, NULL, 0 FROM events),
n AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) - 1 AS sidx, count(*) OVER (PARTITION BY user_id) - 1 AS slen FROM r)
SELECT user_id, CAST(sidx AS INTEGER) AS sidx, CAST(slen AS INTEGER) AS slen, CAST(slen - sidx AS INTEGER) AS ridx, value FROM n""")
def seq_positions(spark: SparkSession, d: str) -> DataFrame:
    return S.positions(_t(spark, d, "events"), "user_id", ["ts", "event_id"], ["value"])


@register("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey IS NOT NULL)")
def seq_childless(spark: SparkSession, d: str) -> DataFrame:
    return S.childless(_t(spark, d, "customer"), "c_custkey", _t(spark, d, "orders").where("o_orderpriority = '1-URGENT'"), "o_custkey").select("c_custkey")


@register("""WITH o AS (SELECT o_custkey, o_totalprice, row_number() OVER w - 1 AS sidx, count(*) OVER (PARTITION BY o_custkey) AS slen FROM orders WHERE o_orderpriority = '1-URGENT' WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, CAST(sidx AS INTEGER) AS sidx, CAST(slen AS INTEGER) AS slen, CAST(slen - sidx AS INTEGER) AS ridx, o_totalprice FROM o
UNION ALL SELECT DISTINCT o_custkey, CAST(slen AS INTEGER), CAST(slen AS INTEGER), 0, 0 FROM o
UNION ALL SELECT c_custkey, 0, 0, 0, 0 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM o)""")
def seq_pad_union(spark: SparkSession, d: str) -> DataFrame:
    rows = S.positions(_t(spark, d, "orders").where("o_orderpriority = '1-URGENT'"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_totalprice"])
    return S.with_empty_entities(rows, "o_custkey", _t(spark, d, "customer"), "c_custkey", ["o_totalprice"])


@register("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS keys, count(*) AS n FROM orders GROUP BY 1")
def seq_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = S.lists(_t(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey"])
    return rows.select("o_custkey", F.concat_ws(",", F.transform("o_orderkey", lambda x: x.cast("string"))).alias("keys"), F.size("o_orderkey").cast("long").alias("n"))


@register("""WITH s AS (SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS keys, count(*) AS n FROM orders GROUP BY 1)
SELECT o_custkey, keys || repeat(',-1', CAST((SELECT max(n) FROM s) - n AS BIGINT)) AS keys FROM s""")
def seq_padded(spark: SparkSession, d: str) -> DataFrame:
    rows = S.padded(S.lists(_t(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey"]), ["o_orderkey"])
    return rows.select("o_custkey", F.concat_ws(",", F.transform("o_orderkey", lambda x: x.cast("string"))).alias("keys"))


@register("SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS INTEGER) AS step, o_orderkey FROM orders")
def seq_flatten(spark: SparkSession, d: str) -> DataFrame:
    rows = S.lists(_t(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey"])
    ridx = F.transform("o_orderkey", lambda x, i: F.size("o_orderkey") - i)
    return S.flattened(rows.withColumn("ridx", ridx), "o_custkey", S.lengths(F.col("ridx")), ["o_orderkey"])


@register("""WITH c AS (SELECT o_custkey, CAST(coalesce(code, 0) AS VARCHAR) AS x, o_orderkey FROM orders LEFT JOIN (SELECT value, row_number() OVER (ORDER BY value) AS code FROM (SELECT o_orderpriority AS value FROM orders GROUP BY 1 HAVING count(*) >= 5)) ON value = o_orderpriority WHERE o_orderpriority >= '4'),
s AS (SELECT o_custkey, string_agg(x, ',' ORDER BY o_orderkey) AS codes, count(*) AS n FROM c GROUP BY 1)
SELECT c_custkey AS o_custkey, trim(coalesce(codes, '') || repeat(',-1', CAST((SELECT max(n) FROM s) - coalesce(n, 0) AS BIGINT)), ',') AS codes FROM customer LEFT JOIN s ON c_custkey = o_custkey""")
def seq_conditions(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    p = P.profile_table(rows.select("o_orderpriority"), privacy=PINNED)
    codes = E.fixed_values(rows.where("o_orderpriority >= '4'"), p, keep=("o_custkey", "o_orderkey"))
    out = S.sequential_conditions(codes, "o_custkey", ["o_orderkey"], ["o_orderpriority__cat"], _t(spark, d, "customer"), "c_custkey")
    return out.select("o_custkey", F.concat_ws(",", F.transform("o_orderpriority__cat", lambda x: x.cast("string"))).alias("codes"))


@register("SELECT o_orderkey, c_mktsegment, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey")
def ctx_join(spark: SparkSession, d: str) -> DataFrame:
    return S.with_parent(_t(spark, d, "orders"), "o_custkey", _t(spark, d, "customer"), "c_custkey", ["c_mktsegment", "c_nationkey"]).select("o_orderkey", "c_mktsegment", "c_nationkey")


@register("""WITH a AS (SELECT s_name, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS i FROM supplier), b AS (SELECT s_nationkey, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier)
SELECT s_name, s_nationkey FROM a JOIN b USING (i)""")
def ctx_zip(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier")
    return S.zipped(s.select("s_name", "s_acctbal", "s_suppkey"), s.select("s_nationkey", F.col("s_suppkey").alias("k")), ["s_acctbal", "s_suppkey"], ["k"]).select("s_name", "s_nationkey")


@register("""WITH n AS (SELECT count(*) AS n FROM orders), r AS (SELECT part, count(*) AS n FROM (SELECT CASE WHEN i < greatest(1, CAST(round_even(n * 0.1, 0) AS BIGINT)) THEN 'val' ELSE 'train' END AS part FROM n, range(n) g(i)) GROUP BY 1) SELECT * FROM r""")
def train_val_split(spark: SparkSession, d: str) -> DataFrame:
    return S.train_split(_t(spark, d, "orders"), ["o_orderkey"], 0.1, 3).groupBy("part").agg(F.count("*").alias("n"))


# keys


def _adrift(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier")
    return s.select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey")).alias("s_nationkey"))


_ADRIFT = "WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 100 ELSE s_nationkey END AS s_nationkey FROM supplier)"


@register(_ADRIFT + " SELECT s_suppkey, s_nationkey FROM s WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation)")
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    return T.orphans(_adrift(spark, d), "s_nationkey", _t(spark, d, "nation"), "n_nationkey")


@register(_ADRIFT + """, o AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS k FROM s WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation)),
p AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS i FROM nation)
SELECT s_suppkey, CASE WHEN k IS NULL THEN s_nationkey ELSE n_nationkey END AS s_nationkey FROM s LEFT JOIN o USING (s_suppkey) LEFT JOIN p ON i = k % (SELECT count(*) FROM nation)""")
def fk_remap(spark: SparkSession, d: str) -> DataFrame:
    return T.remap_orphans(_adrift(spark, d), "s_nationkey", ["s_suppkey"], _t(spark, d, "nation"), "n_nationkey")


@register(f"""WITH e AS (SELECT o_orderkey, o_custkey, c_mktsegment AS s, CASE WHEN {_u(31, "o_orderkey")} < 0.9 THEN c_mktsegment ELSE 'OTHER' END AS c FROM orders JOIN customer ON o_custkey = c_custkey),
w AS (SELECT c, s, sum(count(*)) OVER (PARTITION BY c ORDER BY s) / sum(count(*)) OVER (PARTITION BY c)::DOUBLE AS cum FROM e GROUP BY c, s),
k AS (SELECT c_custkey, c_mktsegment AS s, row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1 AS i FROM customer),
z AS (SELECT s, min(i) AS first, count(*) AS n FROM k GROUP BY s),
d AS (SELECT o_orderkey, c, (SELECT min_by(w.s, w.cum) FROM w WHERE w.c = e.c AND w.cum > {_u(8, "'stratum:o_custkey'", "o_orderkey")}) AS s FROM e)
SELECT o_orderkey, c, k.c_custkey AS o_custkey FROM d JOIN z USING (s) JOIN k ON k.i = z.first + CAST(floor({_u(8, "'key:o_custkey'", "o_orderkey")} * z.n) AS BIGINT)""")
def fk_strata(spark: SparkSession, d: str) -> DataFrame:
    """Orders without keys get customers of the segment that goes with them."""
    customers = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    met = S.with_parent(_t(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", customers, "c_custkey", ["c_mktsegment"])
    orders = met.select("o_orderkey", "o_custkey", F.when(uniform(31, "o_orderkey") < 0.9, F.col("c_mktsegment")).otherwise("OTHER").alias("c"))
    config = resolve_config({"privacy": Privacy(threshold=1), "parent_encoding_types": {"c_mktsegment": "categorical"}})
    p = P.profile_table(orders.select("c"), {"c": "categorical"}, config.privacy)
    strata = T.fit_strata(orders, "o_custkey", p, customers, "c_custkey", ["c_mktsegment"], config)
    return T.matched_keys(orders.select("o_orderkey", "c"), "o_custkey", p, strata, customers, "c_custkey", 8, "o_orderkey")


@register("SELECT row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS id, s_name FROM supplier")
def pk_int(spark: SparkSession, d: str) -> DataFrame:
    return T.assign_key(S.with_index(_t(spark, d, "supplier"), ["s_acctbal", "s_suppkey"], "row_id"), "id", "int").select("id", "s_name")


@register(f"""WITH r AS (SELECT c_custkey, md5('5|' || (row_number() OVER (ORDER BY c_custkey) - 1)) AS h FROM customer),
n AS (SELECT c_custkey, unnest([0, 1]) AS half, CAST('0x' || substr(h, 1 + 16 * unnest([0, 1]), 16) AS UBIGINT) AS n FROM r),
d AS (SELECT c_custkey, half, k, substr('{T.BASE62}', CAST((CAST(n AS HUGEINT) // CAST(pow(62, k) AS HUGEINT)) % 62 AS BIGINT) + 1, 1) AS digit FROM n, range(11) g(k))
SELECT c_custkey, 'dxid_' || string_agg(digit, '' ORDER BY half, k DESC) AS id FROM d GROUP BY 1""")
def pk_random(spark: SparkSession, d: str) -> DataFrame:
    rows = T.assign_key(S.with_index(_t(spark, d, "customer").select("c_custkey"), ["c_custkey"], "row_id"), "id", "dxid", seed=5)
    return rows.select("c_custkey", "id")


# sampling


def _segments(spark: SparkSession, d: str) -> M.Model:
    return M.fit(_t(spark, d, "customer").select("c_mktsegment"), {"privacy": PINNED})


def _draw(u: str) -> str:
    """SQL that draws a segment for each i of `rows` from p (value, cum)."""
    return f"d AS (SELECT i AS row_id, (SELECT min_by(value, cum) FROM p WHERE cum > {u}) AS c_mktsegment FROM rows)"


_SEGMENT_P = "v AS (SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) >= 5)"
_ROWS = "rows AS (SELECT i FROM range(1000) g(i))"
_SEGMENT_U = _u(9, "'c_mktsegment__cat'", "i")


@register(f"WITH {_SEGMENT_P}, p AS (SELECT value, sum(n) OVER (ORDER BY value) / (SELECT sum(n) FROM v)::DOUBLE AS cum FROM v), {_ROWS}, {_draw(_SEGMENT_U)} SELECT * FROM d")
def sample_flat(spark: SparkSession, d: str) -> DataFrame:
    return M.generate(spark, _segments(spark, d), 1000, seed=9)


@register(f"""WITH {_SEGMENT_P}, q AS (SELECT value, CASE WHEN value = 'BUILDING' THEN 0.7 ELSE 0.3 * n / (SELECT sum(n) FROM v WHERE value <> 'BUILDING') END AS x FROM v),
p AS (SELECT value, sum(x) OVER (ORDER BY value) AS cum FROM q), {_ROWS}, {_draw(_SEGMENT_U)} SELECT * FROM d""")
def rebalance(spark: SparkSession, d: str) -> DataFrame:
    return M.generate(spark, _segments(spark, d), 1000, distribution=Distribution("c_mktsegment", {"BUILDING": 0.7}), seed=9)


@register(f"""WITH {_SEGMENT_P}, q AS (SELECT value, pow(n, 1 / 0.25) AS x FROM v), p AS (SELECT value, sum(x) OVER (ORDER BY value) / (SELECT sum(x) FROM q) AS cum FROM q), {_ROWS}, {_draw(_SEGMENT_U)} SELECT * FROM d""")
def temperature(spark: SparkSession, d: str) -> DataFrame:
    return M.generate(spark, _segments(spark, d), 1000, diversity=0.25, seed=9)


@register(f"""WITH {_SEGMENT_P}, o AS (SELECT value, n, coalesce(sum(n) OVER (ORDER BY n DESC, value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM v),
k AS (SELECT value, n FROM o WHERE ahead < 0.5 * (SELECT sum(n) FROM v)), p AS (SELECT value, sum(n) OVER (ORDER BY value) / (SELECT sum(n) FROM k)::DOUBLE AS cum FROM k), {_ROWS}, {_draw(_SEGMENT_U)} SELECT * FROM d""")
def nucleus(spark: SparkSession, d: str) -> DataFrame:
    return M.generate(spark, _segments(spark, d), 1000, rare_cutoff=0.5, seed=9)


def _nation_model(spark: SparkSession, d: str) -> M.Model:
    rows = _t(spark, d, "customer").select(F.when(F.col("c_nationkey") % 2 == 0, "even").otherwise("odd").alias("g"), F.when((F.col("c_nationkey") % 2 == 0) & (F.col("c_acctbal") > 0), "rich").otherwise("poor").alias("t"))
    return M.fit(rows, {"privacy": PINNED})


@register(f"""WITH c AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS g, CASE WHEN c_nationkey % 2 = 0 AND c_acctbal > 0 THEN 'rich' ELSE 'poor' END AS t FROM customer),
pg AS (SELECT g AS value, sum(count(*)) OVER (ORDER BY g) / (SELECT count(*) FROM c)::DOUBLE AS cum FROM c GROUP BY g), pt AS (SELECT t AS value, sum(count(*)) OVER (ORDER BY t) / (SELECT count(*) FROM c)::DOUBLE AS cum FROM c GROUP BY t), {_ROWS}
SELECT i AS row_id, (SELECT min_by(value, cum) FROM pg WHERE cum > {_u(9, "'g__cat'", "i")}) AS g, (SELECT min_by(value, cum) FROM pt WHERE cum > {_u(9, "'t__cat'", "i")}) AS t FROM rows""")
def bias_parity(spark: SparkSession, d: str) -> DataFrame:
    return M.generate(spark, _nation_model(spark, d), 1000, bias=Bias("t", ("g",)), seed=9)


_PROXY = """WITH c AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS g, CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 20 > 0 THEN 'yes' ELSE 'no' END AS h,
  CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 20 > 0 AND c_acctbal > 0 THEN 'rich' ELSE 'poor' END AS t FROM customer)"""


@register(f"""{_PROXY}, p AS (SELECT t AS value, sum(count(*)) OVER (ORDER BY t) / (SELECT count(*) FROM c)::DOUBLE AS cum FROM c GROUP BY t), {_ROWS}
SELECT i AS row_id, (SELECT min_by(value, cum) FROM p WHERE cum > {_u(9, "'t__cat'", "i")}) AS t FROM rows""")
def bias_proxy(spark: SparkSession, d: str) -> DataFrame:
    """The target stays independent of a sensitive column when a third one nearly repeats it."""
    even = F.col("c_nationkey") % 2 == 0
    yes = even & (F.col("c_custkey") % 20 > 0)
    rows = _t(spark, d, "customer").select(F.when(even, "even").otherwise("odd").alias("g"), F.when(yes, "yes").otherwise("no").alias("h"), F.when(yes & (F.col("c_acctbal") > 0), "rich").otherwise("poor").alias("t"))
    return M.generate(spark, M.fit(rows, {"privacy": PINNED}), 1000, bias=Bias("t", ("g",)), seed=9).select("row_id", "t")


@register(f"""WITH c AS (SELECT c_custkey, c_mktsegment AS s, n_regionkey AS r FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT r, s, sum(count(*)) OVER (PARTITION BY r ORDER BY s) / sum(count(*)) OVER (PARTITION BY r)::DOUBLE AS cum FROM c GROUP BY r, s)
SELECT c_custkey AS row_id, (SELECT min_by(s, cum) FROM p WHERE p.r = c.r AND cum > {_u(9, "'c_mktsegment__cat'", "c_custkey")}) AS c_mktsegment FROM c""")
def sample_context(spark: SparkSession, d: str) -> DataFrame:
    """New child rows drawn given their parents' columns."""
    nation = _t(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").cast("string").alias("region"))
    child = _t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    both = M.with_context(child, nation, [], [], "c_nationkey", "n_nationkey")
    model = M.fit(both.drop("c_custkey", "c_nationkey"), {"privacy": Privacy(threshold=1), "encoding_types": {"parent:region": "categorical", "c_mktsegment": "categorical"}})
    return M.generate_with_context(spark, model, both.select(F.col("c_custkey").alias("row_id"), F.col("`parent:region`").alias("region")), "row_id", seed=9)


_PATHS = f"""e AS (SELECT user_id, event_type AS c, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
m AS (SELECT coalesce(b.c, '') AS prev, a.c AS c, count(*) AS n FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND a.pos = b.pos + 1 GROUP BY 1, 2),
cdf AS (SELECT prev, c, sum(n) OVER (PARTITION BY prev ORDER BY c) / sum(n) OVER (PARTITION BY prev)::DOUBLE AS cum FROM m),
z AS (SELECT n, sum(count(*)) OVER (ORDER BY n) / (SELECT count(DISTINCT user_id) FROM events)::DOUBLE AS cum FROM (SELECT count(*) AS n FROM events GROUP BY user_id) GROUP BY n),
f AS (SELECT user_id, event_type AS given, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events WHERE event_type = 'purchase'),
l AS (SELECT user_id, greatest((SELECT min_by(n, cum) FROM z WHERE cum > {_u(6, "'length'", "user_id")}), (SELECT count(*) FROM f WHERE f.user_id = u.user_id)) AS n FROM (SELECT DISTINCT user_id FROM events) u),
g AS (SELECT user_id, pos, given, {_u(6, "'event_type__cat'", "user_id", "pos")} AS u FROM l JOIN (SELECT unnest(range(1, (SELECT max(n) + 1 FROM l))) AS pos) ON pos <= n LEFT JOIN f USING (user_id, pos)),
paths AS (SELECT user_id, CAST(0 AS BIGINT) AS pos, '' AS c FROM l UNION ALL
  SELECT g.user_id, CAST(g.pos AS BIGINT), coalesce(g.given, (SELECT min_by(cdf.c, cdf.cum) FROM cdf WHERE cdf.prev = paths.c AND cdf.cum > g.u)) FROM paths JOIN g ON g.user_id = paths.user_id AND g.pos = paths.pos + 1)"""


@register(f"WITH RECURSIVE {_PATHS} SELECT user_id, CAST(pos - 1 AS INTEGER) AS step, c AS event_type FROM paths WHERE pos > 0")
def sample_sequence_fixed(spark: SparkSession, d: str) -> DataFrame:
    """Sequences whose first steps are given: a user's purchases."""
    rows = _t(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    model = M.fit(rows, {"privacy": PINNED}, "user_id", ["ts", "event_id"])
    return M.generate_sequences(spark, model, rows.select("user_id").distinct(), "user_id", conditions=rows.where("event_type = 'purchase'"), seed=6)


@register(f"""WITH c AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS g, CASE WHEN c_nationkey % 2 = 0 AND c_acctbal > 0 THEN 'rich' ELSE 'poor' END AS t FROM customer),
pg AS (SELECT g AS value, sum(count(*)) OVER (ORDER BY g) / (SELECT count(*) FROM c)::DOUBLE AS cum FROM c GROUP BY g),
pt AS (SELECT g, t AS value, sum(count(*)) OVER (PARTITION BY g ORDER BY t) / sum(count(*)) OVER (PARTITION BY g)::DOUBLE AS cum FROM c GROUP BY g, t), {_ROWS},
a AS (SELECT i, (SELECT min_by(value, cum) FROM pg WHERE cum > {_u(9, "'g__cat'", "i")}) AS g FROM rows)
SELECT i AS row_id, g, (SELECT min_by(value, cum) FROM pt WHERE pt.g = a.g AND cum > {_u(9, "'t__cat'", "i")}) AS t FROM a""")
def sample_chain(spark: SparkSession, d: str) -> DataFrame:
    return M.generate(spark, _nation_model(spark, d), 1000, seed=9)


@register(_HOLED + """, v AS (SELECT o_orderpriority AS value, CAST(row_number() OVER (ORDER BY o_orderpriority) + 1 AS INTEGER) AS code FROM h WHERE o_orderpriority IS NOT NULL GROUP BY 1 HAVING count(*) >= 5)
SELECT o_orderkey, CASE WHEN o_orderpriority IS NULL THEN -1 ELSE coalesce(code, 0) END AS o_orderpriority__cat FROM h LEFT JOIN v ON value = o_orderpriority""")
def fixed_codes(spark: SparkSession, d: str) -> DataFrame:
    rows = _holed(spark, d).select("o_orderkey", "o_orderpriority")
    return E.fixed_values(rows, P.profile_table(rows.select("o_orderpriority"), privacy=PINNED), ("o_orderpriority",), ("o_orderkey",))


@register(_HOLED + """, w AS (SELECT o_orderpriority AS value, count(*) AS n FROM h WHERE o_orderpriority IS NOT NULL GROUP BY 1 HAVING count(*) >= 5),
p AS (SELECT value, sum(n) OVER (ORDER BY value) / (SELECT sum(n) FROM w)::DOUBLE AS cum FROM w),
t AS (""" + " UNION ALL ".join(f"SELECT o_orderkey, (SELECT min_by(value, cum) FROM p WHERE cum > {_u(20 + k, chr(39) + 'o_orderpriority__cat' + chr(39), 'o_orderkey')}) AS v FROM h WHERE o_orderpriority IS NULL" for k in range(3)) + """),
m AS (SELECT o_orderkey, v, count(*) AS n FROM t GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY n DESC, v) = 1)
SELECT o_orderkey, coalesce(o_orderpriority, v) AS o_orderpriority FROM h LEFT JOIN m USING (o_orderkey)""")
def impute_mode(spark: SparkSession, d: str) -> DataFrame:
    rows = _holed(spark, d).select("o_orderkey", "o_orderpriority")
    return M.impute(spark, M.fit(rows.select("o_orderpriority"), {"privacy": PINNED}), rows, "o_orderkey", 3, "mode", seed=20)


@register(f"""WITH v AS (SELECT CAST(l_partkey AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 1),
p AS (SELECT value, sum(n) OVER (ORDER BY value) / (SELECT count(*) FROM lineitem)::DOUBLE AS cum FROM v),
r AS (SELECT i, {_u(9, "'item__cat'", "i")} AS u FROM range((SELECT count(*) FROM lineitem)) g(i))
SELECT i AS row_id, value AS item FROM r ASOF JOIN p ON r.u < p.cum""")
def sample_many_categories(spark: SparkSession, d: str) -> DataFrame:
    """As many new rows as there are lineitems, of a column with a category for each part."""
    rows = _t(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("item"))
    return M.generate(spark, M.fit(rows, {"privacy": Privacy(threshold=1), "encoding_types": {"item": "categorical"}}), seed=9)


_DEPENDENT = """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'none' ELSE 'some' END AS g, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS s FROM customer),
v AS (SELECT s AS value, sum(count(*)) OVER (ORDER BY s) / (SELECT count(s) FROM c)::DOUBLE AS cum FROM c WHERE s IS NOT NULL GROUP BY s)"""


@register(f"""{_DEPENDENT} SELECT c_custkey, g, coalesce(s, (SELECT min_by(value, cum) FROM v WHERE cum > {_u(9, "'s__cat'", "c_custkey")})) AS s FROM c""")
def impute_dependent(spark: SparkSession, d: str) -> DataFrame:
    """A column that is null exactly where another one says so: cells are filled from all rows, since the group of the null has nothing else."""
    none = F.col("c_custkey") % 3 == 0
    rows = _t(spark, d, "customer").select("c_custkey", F.when(none, "none").otherwise("some").alias("g"), F.when(~none, F.col("c_mktsegment")).alias("s"))
    model = M.fit(rows.drop("c_custkey"), {"privacy": PINNED, "encoding_types": {"g": "categorical", "s": "categorical"}})
    return M.impute(spark, model, rows, "c_custkey", seed=9)


@register(_HOLED + f""", s AS (SELECT o_totalprice AS x, row_number() OVER (ORDER BY o_totalprice) - 1 AS k, count(*) OVER () AS n FROM h WHERE o_totalprice IS NOT NULL),
p AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice IS NULL THEN CAST(floor({_u(5, "'o_totalprice'", "o_orderkey")} * (SELECT max(n) FROM s)) AS BIGINT) END AS k FROM h),
b AS (SELECT (SELECT o_totalprice FROM h WHERE o_totalprice IS NOT NULL ORDER BY 1 LIMIT 1 OFFSET 5) AS lo, (SELECT o_totalprice FROM h WHERE o_totalprice IS NOT NULL ORDER BY 1 DESC LIMIT 1 OFFSET 5) AS hi),
f AS (SELECT CAST(floor(least(greatest(coalesce(o_totalprice, x), lo), hi) / 10) AS BIGINT) % 10 AS digit FROM p LEFT JOIN s USING (k), b)
SELECT CAST(digit AS INTEGER) AS digit, count(*) AS n FROM f GROUP BY 1""")
def fit_null_fill(spark: SparkSession, d: str) -> DataFrame:
    """What a model counts of a digit: nulls stand there as values drawn from the other rows."""
    rows = _holed(spark, d).select("o_orderkey", "o_totalprice")
    model = M.fit(rows, {"privacy": PINNED, "encoding_types": {"o_totalprice": "numeric_digit"}, "seed": 5}, row="o_orderkey")
    at, low = model.columns.index("o_totalprice__E1"), model.profile.columns["o_totalprice"].low["E1"]
    return model.pairs.where((F.col("i") == at) & (F.col("j") == at)).select((F.col("a") + low).cast("int").alias("digit"), "n")


_STEPS = f"""e AS (SELECT user_id, event_type AS c, CASE WHEN {_u(31, "event_id")} < 0.9 THEN upper(event_type) ELSE 'OTHER' END AS band, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
m AS (SELECT a.pos = 1 AS first, coalesce(b.c, '') AS prev, a.c AS c, count(*) AS n FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND a.pos = b.pos + 1 GROUP BY 1, 2, 3),
cdf AS (SELECT prev, c, sum(n) OVER (PARTITION BY prev ORDER BY c) / sum(n) OVER (PARTITION BY prev)::DOUBLE AS cum FROM m),
w AS (SELECT pos = 1 AS first, c, band, sum(count(*)) OVER (PARTITION BY pos = 1, c ORDER BY band) / sum(count(*)) OVER (PARTITION BY pos = 1, c)::DOUBLE AS cum FROM e GROUP BY 1, 2, 3),
z AS (SELECT n, sum(count(*)) OVER (ORDER BY n) / (SELECT count(DISTINCT user_id) FROM events)::DOUBLE AS cum FROM (SELECT count(*) AS n FROM events GROUP BY user_id) GROUP BY n),
l AS (SELECT user_id, (SELECT min_by(n, cum) FROM z WHERE cum > {_u(6, "'length'", "user_id")}) AS n FROM (SELECT DISTINCT user_id FROM events) u),
g AS (SELECT user_id, pos, {_u(6, "'event_type__cat'", "user_id", "pos")} AS u, {_u(6, "'band__cat'", "user_id", "pos")} AS v FROM l JOIN (SELECT unnest(range(1, (SELECT max(n) + 1 FROM l))) AS pos) ON pos <= n),
paths AS (SELECT user_id, CAST(0 AS BIGINT) AS pos, '' AS c FROM l UNION ALL
  SELECT g.user_id, CAST(g.pos AS BIGINT), (SELECT min_by(cdf.c, cdf.cum) FROM cdf WHERE cdf.prev = paths.c AND cdf.cum > g.u) FROM paths JOIN g ON g.user_id = paths.user_id AND g.pos = paths.pos + 1)"""


@register(f"""WITH RECURSIVE {_STEPS}
SELECT p.user_id, CAST(p.pos - 1 AS INTEGER) AS step, p.c AS event_type, (SELECT min_by(w.band, w.cum) FROM w WHERE w.first = (p.pos = 1) AND w.c = p.c AND w.cum > g.v) AS band FROM paths p JOIN g USING (user_id, pos)""")
def sample_sequence_joint(spark: SparkSession, d: str) -> DataFrame:
    """Sequences whose second column depends on the first one of the same step."""
    band = F.when(uniform(31, "event_id") < 0.9, F.upper("event_type")).otherwise("OTHER")
    rows = _t(spark, d, "events").select("user_id", "ts", "event_id", "event_type", band.alias("band"))
    model = M.fit(rows, {"privacy": PINNED}, "user_id", ["ts", "event_id"])
    return M.generate_sequences(spark, model, rows.select("user_id").distinct(), "user_id", seed=6)


@register(f"""WITH e AS (SELECT o_custkey, c_mktsegment AS s, CASE WHEN {_u(31, "o_orderkey")} < 0.9 THEN c_mktsegment ELSE 'OTHER' END AS c, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos FROM orders JOIN customer ON o_custkey = c_custkey),
w AS (SELECT pos = 1 AS first, s, c, sum(count(*)) OVER (PARTITION BY pos = 1, s ORDER BY c) / sum(count(*)) OVER (PARTITION BY pos = 1, s)::DOUBLE AS cum FROM e GROUP BY 1, 2, 3),
h AS (SELECT c_custkey, c_mktsegment AS s, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey),
z AS (SELECT n, sum(count(*)) OVER (ORDER BY n) / (SELECT count(*) FROM h)::DOUBLE AS cum FROM h GROUP BY n),
l AS (SELECT c_custkey, s, (SELECT min_by(n, cum) FROM z WHERE cum > {_u(6, "'length'", "c_custkey")}) AS n FROM h),
g AS (SELECT c_custkey, s, pos, {_u(6, "'c__cat'", "c_custkey", "pos")} AS u FROM l JOIN (SELECT unnest(range(1, (SELECT max(n) + 1 FROM l))) AS pos) ON pos <= n)
SELECT c_custkey AS o_custkey, CAST(pos - 1 AS INTEGER) AS step, (SELECT min_by(w.c, w.cum) FROM w WHERE w.first = (g.pos = 1) AND w.s = g.s AND w.cum > g.u) AS c FROM g""")
def sample_sequence_parents(spark: SparkSession, d: str) -> DataFrame:
    """Sequences that follow a column of their parents at every step."""
    customers = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    orders = S.with_parent(_t(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey", customers, "c_custkey", ["c_mktsegment"])
    rows = orders.select("o_custkey", "o_orderdate", "o_orderkey", F.when(uniform(31, "o_orderkey") < 0.9, F.col("c_mktsegment")).otherwise("OTHER").alias("c"))
    model = M.fit(rows, {"privacy": Privacy(threshold=1)}, "o_custkey", ["o_orderdate", "o_orderkey"], customers, "c_custkey", ["c_mktsegment"])
    return M.generate_sequences(spark, model, customers, "c_custkey", seed=6)


@register(f"""WITH c AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS g, CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 20 > 0 THEN 'yes' ELSE 'no' END AS h,
  CASE WHEN {_u(41, "c_custkey")} < 0.5 THEN 'a' ELSE 'b' END AS x, CASE WHEN {_u(42, "c_custkey")} < CASE WHEN {_u(41, "c_custkey")} < 0.5 THEN 0.8 ELSE 0.2 END * CASE WHEN c_nationkey % 2 = 0 THEN 1.0 ELSE 0.5 END THEN 'rich' ELSE 'poor' END AS t FROM customer),
pg AS (SELECT g AS value, sum(count(*)) OVER (ORDER BY g) / (SELECT count(*) FROM c)::DOUBLE AS cum FROM c GROUP BY g),
ph AS (SELECT g, h AS value, sum(count(*)) OVER (PARTITION BY g ORDER BY h) / sum(count(*)) OVER (PARTITION BY g)::DOUBLE AS cum FROM c GROUP BY g, h),
px AS (SELECT x AS value, sum(count(*)) OVER (ORDER BY x) / (SELECT count(*) FROM c)::DOUBLE AS cum FROM c GROUP BY x),
pt AS (SELECT x, t AS value, sum(count(*)) OVER (PARTITION BY x ORDER BY t) / sum(count(*)) OVER (PARTITION BY x)::DOUBLE AS cum FROM c GROUP BY x, t), {_ROWS},
a AS (SELECT i, (SELECT min_by(value, cum) FROM pg WHERE cum > {_u(9, "'g__cat'", "i")}) AS g, (SELECT min_by(value, cum) FROM px WHERE cum > {_u(9, "'x__cat'", "i")}) AS x FROM rows)
SELECT i AS row_id, g, (SELECT min_by(value, cum) FROM ph WHERE ph.g = a.g AND cum > {_u(9, "'h__cat'", "i")}) AS h, x, (SELECT min_by(value, cum) FROM pt WHERE pt.x = a.x AND cum > {_u(9, "'t__cat'", "i")}) AS t FROM a""")
def bias_admissible(spark: SparkSession, d: str) -> DataFrame:
    """The target keeps what it has to do with an admissible column, and nothing of a sensitive one and its proxy."""
    even, a = F.col("c_nationkey") % 2 == 0, uniform(41, "c_custkey") < 0.5
    rich = uniform(42, "c_custkey") < F.when(a, 0.8).otherwise(0.2) * F.when(even, 1.0).otherwise(0.5)
    rows = _t(spark, d, "customer").select(F.when(even, "even").otherwise("odd").alias("g"), F.when(even & (F.col("c_custkey") % 20 > 0), "yes").otherwise("no").alias("h"), F.when(a, "a").otherwise("b").alias("x"), F.when(rich, "rich").otherwise("poor").alias("t"))
    return M.generate(spark, M.fit(rows, {"privacy": PINNED}), 1000, bias=Bias("t", ("g",)), seed=9)


_DRAWS = """WITH t AS (SELECT o_custkey, o_totalprice AS x FROM orders) """


@register(_DRAWS + " SELECT o_custkey, round(avg(x), 5) AS mean, median(x) AS median, (SELECT y.x FROM (SELECT t2.x, count(*) AS n FROM t t2 WHERE t2.o_custkey = t.o_custkey GROUP BY 1 ORDER BY n DESC, x LIMIT 1) y) AS mode FROM t GROUP BY 1")
def trial_picks(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("o_totalprice")
    return _t(spark, d, "orders").groupBy("o_custkey").agg(*[M.pick_cell(k, x).alias(k) for k in ("mean", "median", "mode")]).withColumn("mean", F.round("mean", 5))


@register(_HOLED + " SELECT h.o_orderkey, coalesce(h.o_totalprice, o.o_totalprice) AS o_totalprice FROM h JOIN orders o USING (o_orderkey)")
def impute_preserve(spark: SparkSession, d: str) -> DataFrame:
    return S.restored(_holed(spark, d).select("o_orderkey", "o_totalprice"), _t(spark, d, "orders"), ["o_orderkey"], ["o_totalprice"])


@register("""SELECT 'missing' AS check_name, CAST(0 AS BIGINT) AS bad UNION ALL SELECT 'orders', 0 UNION ALL SELECT 'keys', 0""")
def multitable_integrity(spark: SparkSession, d: str) -> DataFrame:
    """Counts of broken keys in new customers and their orders."""
    from pyspark import StorageLevel

    tables = {
        "customer": T.Table(_t(spark, d, "customer").drop("c_name"), "c_custkey"),
        "orders": T.Table(_t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", F.col("o_orderkey").alias("o_at")).drop("o_at"), "o_orderkey", {"o_custkey": "customer"}, True, order=("o_orderdate",)),
    }
    new = T.synthesize_tables(spark, tables, config={"privacy": PINNED}, seed=4)
    c, o = (new[k].persist(StorageLevel.DISK_ONLY) for k in ("customer", "orders"))
    lost = T.orphans(o, "o_custkey", c, "c_custkey").agg(F.lit("orders").alias("check_name"), F.count("*").alias("bad"))
    twice = o.agg(F.lit("keys").alias("check_name"), (F.count("*") - F.count_distinct("o_orderkey")).alias("bad"))
    missing = o.agg(F.lit("missing").alias("check_name"), F.count(F.when(F.col("o_orderdate").isNull(), 1)).alias("bad"))
    return lost.union(twice).union(missing)


@register()
def sample_sequence(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    model = M.fit(rows, {"privacy": PINNED}, "user_id", ["ts", "event_id"])
    return M.generate_sequences(spark, model, n=50, seed=6)


@register()
def embed_project(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    p = P.profile_table(rows.drop("c_custkey"), privacy=PINNED)
    return project(E.encode_columns(rows, p, ("c_custkey",)), p, 16, 3, ("c_custkey",))


_CODED = """seg AS (SELECT s AS v, row_number() OVER (ORDER BY s) AS code FROM (SELECT c_mktsegment AS s FROM customer GROUP BY 1 HAVING count(*) >= 5)),
nat AS (SELECT n AS v, row_number() OVER (ORDER BY CAST(n AS VARCHAR)) AS code FROM (SELECT c_nationkey AS n FROM customer GROUP BY 1 HAVING count(*) >= 5)),
c AS (SELECT c_custkey, coalesce(seg.code, 0) AS a, coalesce(nat.code, 0) AS b FROM customer LEFT JOIN seg ON seg.v = c_mktsegment LEFT JOIN nat ON nat.v = c_nationkey),
x AS (SELECT c_custkey, """ + ", ".join(f"CAST((a + 1) * {3 * (k + 2)} % 13 + (b + 1) * {5 * (k + 2)} % 13 AS DOUBLE) AS x{k}" for k in range(4)) + " FROM c)"


def _coded_customers(spark: SparkSession, d: str) -> tuple[DataFrame, P.Profile, TableEncoder]:
    """Customers' codes, and whole weights for them by a rule."""
    rows = _t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    p = P.profile_table(rows.drop("c_custkey"), {"c_mktsegment": "categorical", "c_nationkey": "numeric_discrete"}, PINNED)
    rule = lambda n, step: np.array([[(code + 1) * step * (k + 2) % 13 for k in range(4)] for code in range(n)], float)
    tables = {f"emb:{c}": rule(n, step) for (c, n), step in zip(p.cardinalities.items(), (3, 5), strict=True)}
    return E.encode_columns(rows, p, ("c_custkey",)), p, TableEncoder(tables, 4)


def _components(name: str) -> list:
    return [F.get(name, F.lit(k)).cast("double").alias(f"x{k}") for k in range(4)]


@register(f"WITH {_CODED} SELECT c_custkey, x0, x1, x2, x3 FROM x")
def embed_tables(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of customers by given weights."""
    codes, p, encoder = _coded_customers(spark, d)
    return embed(codes, p, encoder, encoder.fit(codes, p), ("c_custkey",)).select("c_custkey", *_components("embedding"))


@register(f"WITH {_CODED} SELECT o_orderkey, x0, x1, x2, x3 FROM orders LEFT JOIN x ON c_custkey = o_custkey")
def ctx_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the vectors of their customers, made once per customer."""
    codes, p, encoder = _coded_customers(spark, d)
    vectors = context_vectors(codes, "c_custkey", p, encoder, encoder.fit(codes, p))
    return with_context_vectors(_t(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", vectors, "c_custkey").select("o_orderkey", *_components("context"))


@register(f"WITH {_CODED} SELECT c_custkey, CAST(a AS INTEGER) AS segment, CAST(b AS INTEGER) AS nation FROM c")
def embed_fitted(spark: SparkSession, d: str) -> DataFrame:
    """Customers' codes as their vectors tell them, with as many fitted directions as codes."""
    codes, p, _ = _coded_customers(spark, d)
    encoder = LinearEncoder(dim=sum(p.cardinalities.values()), rounds=2, seed=3)
    state = encoder.fit(codes, p)
    told = told_codes(embed(codes, p, encoder, state, ("c_custkey",)), p, state, ("c_custkey",))
    return told.select("c_custkey", F.col("c_mktsegment__cat").alias("segment"), F.col("c_nationkey__cat").alias("nation"))


@register(f"SELECT c_custkey, round(-2 * sign({_u(1, 'c_custkey')} - 0.5) * ln(greatest(1 - 2 * abs({_u(1, 'c_custkey')} - 0.5), 1e-300)), 9) AS lap, round(sqrt(-2 * ln(greatest({_u(2, 'c_custkey')}, 1e-300))) * cos(2 * pi() * {_u(3, 'c_custkey')}), 9) AS nor FROM customer")
def noise(spark: SparkSession, d: str) -> DataFrame:
    k = "c_custkey"
    return _t(spark, d, "customer").select(k, F.round(laplace(uniform(1, k), 2.0), 9).alias("lap"), F.round(normal(uniform(2, k), uniform(3, k)), 9).alias("nor"))


@register("SELECT 'c_mktsegment__cat' AS feature, CAST(0 AS INTEGER) AS code, 0.0::DOUBLE AS p UNION ALL SELECT 'c_mktsegment__cat', CAST((SELECT count(*) FROM (SELECT c_mktsegment FROM customer WHERE c_mktsegment <= 'BUILDING' GROUP BY 1 HAVING count(*) >= 5)) AS INTEGER), 0.25")
def constraint_weights(spark: SparkSession, d: str) -> DataFrame:
    p = P.profile_table(_t(spark, d, "customer").select("c_mktsegment"), privacy=PINNED)
    w = C.merged_weights(C.rare_weights(p, "sample"), C.imputation_weights(p, ["c_mktsegment"]), C.distribution_weights(p, [Distribution("c_mktsegment", {"BUILDING": 0.25})]))
    return spark.createDataFrame([(c, k, float(x)) for c, codes in w.items() for k, x in codes.items()], "feature string, code int, p double")
