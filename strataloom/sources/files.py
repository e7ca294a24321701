"""Reading and writing of tables, profiles and embeddings."""

from __future__ import annotations

import base64
import json
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.errors import InvalidRequestError
from strataloom.operators.profile import ColumnProfile, Profile

FORMATS = ("parquet", "orc", "json", "csv")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """A table of files; csv and json need a schema, so that no pass is spent on guessing."""
    if fmt not in FORMATS:
        raise InvalidRequestError(f"format must be one of {FORMATS}", "fmt")
    if fmt in ("csv", "json") and schema is None:
        raise InvalidRequestError(f"{fmt} needs a schema", "schema")
    reader = spark.read.format(fmt).option("header", "true") if fmt == "csv" else spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Write a table, replacing what is there."""
    if fmt not in FORMATS:
        raise InvalidRequestError(f"format must be one of {FORMATS}", "fmt")
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).partitionBy(*partition_by).save(path)


def write_profile(spark: SparkSession, profile: Profile, path: str) -> None:
    """A profile as one row of JSON per column; categories that it holds as tables go to a folder beside it, `path`-labels."""
    rows = [(i, json.dumps(c.plain())) for i, c in enumerate(profile.columns.values())]
    spark.createDataFrame(rows, "at int, profile string").coalesce(1).write.mode("overwrite").parquet(path)
    tables = [c.table.withColumn("at", F.lit(i)) for i, c in enumerate(profile.columns.values()) if c.table is not None]
    if tables:
        reduce(DataFrame.union, tables).write.mode("overwrite").partitionBy("at").parquet(f"{path}-labels")


def read_profile(spark: SparkSession, path: str) -> Profile:
    """What write_profile wrote."""
    out = {}
    for r in spark.read.parquet(path).orderBy("at").collect():
        own = json.loads(r.profile)
        own["bounds"] = tuple(own["bounds"]) if own["bounds"] else None
        out[own["name"]] = c = ColumnProfile(**own)
        if len(c.labels) < c.n_labels:
            c.table = spark.read.parquet(f"{path}-labels").where(F.col("at") == r.at).select("value", "code")
    return Profile(out)


def write_weights(spark: SparkSession, weights: dict[str, np.ndarray], path: str) -> None:
    """Weight tables by name, a row of numbers per row."""
    rows = [(name, i, [float(x) for x in row]) for name, w in weights.items() for i, row in enumerate(w)]
    spark.createDataFrame(rows, "name string, at int, row array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def read_weights(spark: SparkSession, path: str) -> dict[str, np.ndarray]:
    """What write_weights wrote."""
    out: dict[str, list] = {}
    for r in spark.read.parquet(path).orderBy("name", "at").collect():
        out.setdefault(r.name, []).append(r.row)
    return {k: np.array(v) for k, v in out.items()}


def embedding_to_json(c: Column) -> Column:
    return F.to_json(c)


def embedding_from_json(c: Column) -> Column:
    return F.from_json(c, "array<float>")


def embedding_to_base64(c: Column) -> Column:
    """An array of floats as base64 of its 32-bit little-endian floats; a null component becomes NaN."""

    @F.pandas_udf("string")
    def coded(v: pd.Series) -> pd.Series:
        return v.map(lambda x: None if x is None else base64.b64encode(np.asarray(x, "<f4").tobytes()).decode())

    return coded(c)


def embedding_from_base64(c: Column) -> Column:
    """What embedding_to_base64 wrote; null for null."""

    @F.pandas_udf("array<float>")
    def read(v: pd.Series) -> pd.Series:
        return v.map(lambda x: None if x is None else np.frombuffer(base64.b64decode(x), "<f4"))

    return read(c)
