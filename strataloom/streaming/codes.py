"""Encoding of streams by a fitted profile, and counts of codes over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.operators.encode import encode_columns
from strataloom.operators.profile import Profile


def encode_stream(stream: DataFrame, profile: Profile, keep: tuple[str, ...]) -> DataFrame:
    """A stream's columns as codes; a projection without state, as in batch."""
    return encode_columns(stream, profile, keep)


def drift(stream: DataFrame, column: str, time: str, every: str, late: str) -> DataFrame:
    """(window, code, n): rows by code and window of event time; rows later than `late` don't count."""
    return stream.withWatermark(time, late).groupBy(F.window(time, every), F.col(f"`{column}`").alias("code")).agg(F.count("*").alias("n"))
