"""Random numbers that depend on a seed and on keys only, so that a retried task draws the same ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int | Column, *keys: Column | str) -> Column:
    """A uniform number in [0, 1) of the seed and the keys: 52 bits of an MD5."""
    text = F.concat_ws("|", seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed)), *[F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def laplace(u: Column, scale: float) -> Column:
    """A Laplace number of the given scale from a uniform one."""
    c = u - 0.5
    return -scale * F.signum(c) * F.log(F.greatest(1 - 2 * F.abs(c), F.lit(1e-300)))


def normal(u1: Column, u2: Column) -> Column:
    """A standard normal number from two uniform ones."""
    return F.sqrt(-2 * F.log(F.greatest(u1, F.lit(1e-300)))) * F.cos(2 * F.pi() * u2)


def any_seed(seed: int | None) -> int:
    """The seed, or a new one."""
    import secrets

    return secrets.randbits(31) if seed is None else seed
