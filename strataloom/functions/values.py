"""Conversions between values and the parts that codes are made of. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved tokens, limits and formats.
RARE, NULL, ESCAPE = "<protected>", "<<NULL>>", "\x01"
UNKNOWN, MINIMUM, MAXIMUM = "<<UNK>>", "<<MIN>>", "<<MAX>>"
PAD, MAX_CHARS = "\0", 50
HIGHEST_DIGIT, LOWEST_DIGIT = 18, -8
NUMBER = r"(-?[0-9]*[\.]?[0-9]+(?:[eE][+\-]?\d+)?)"
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "dd.MM.yyyy", "MMM d yyyy", "d MMM yyyy")
MONTH_FIRST = ("MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss")
DAY_FIRST = ("dd/MM/yyyy", "dd/MM/yyyy HH:mm:ss")


def to_text(c: Column, kind: str) -> Column:
    """A value as text; booleans as True and False, floats and doubles in full from 1e-4 up to 1e16 and else with an exponent of two digits at least. The digits are the JVM's, which are not always the fewest."""
    if kind == "boolean":
        return F.when(c, "True").when(~c, "False")
    return _double_text(c) if kind in ("double", "float") else c.cast("string")


def _double_text(c: Column) -> Column:
    text = c.cast("string")
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(text, "E", 1), "[-.]", ""), "(?<=.)0+$", "")
    sign, exponent = F.when(text.startswith("-"), "-").otherwise(""), F.substring_index(text, "E", -1).try_cast("int")
    wide = F.concat(F.rpad(digits, exponent + 1, F.lit("0")), F.lit("."), F.when(F.length(digits) > exponent + 1, F.substring(digits, exponent + 2, F.length(digits))).otherwise("0"))
    near = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    far = F.concat(F.left(digits, F.lit(1)), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), F.length(digits)))).otherwise(""), F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")))
    return F.when(~text.contains("E"), text).otherwise(F.concat(sign, F.when((exponent >= 0) & (exponent < 16), wide).when((exponent < 0) & (exponent >= -4), near).otherwise(far)))


def escape_tokens(c: Column) -> Column:
    """Text in which no value equals a reserved token; unescape_tokens undoes it."""
    return F.when(c.startswith(ESCAPE), F.concat(F.lit(ESCAPE), c)).when(c.isin(RARE, NULL), F.concat(F.lit(ESCAPE), c)).otherwise(c)


def unescape_tokens(c: Column) -> Column:
    return F.when(c.startswith(ESCAPE), F.substring(c, F.lit(2), F.length(c))).otherwise(c)


def to_number(c: Column, kind: str = "string") -> Column:
    """The first number of a text, or null; booleans are 0 and 1. NaN is null."""
    if kind == "boolean":
        return c.cast("int").cast("double")
    out = F.regexp_extract(c, NUMBER, 1).try_cast("double") if kind == "string" else c.cast("double")
    return F.when(~F.isnan(out), out)


def _parsed(c: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(F.try_to_timestamp(F.when(c.rlike(r"^\d{4}-\d"), c)), *[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def to_datetime(c: Column, day_first: bool = False) -> Column:
    """A text as a timestamp: ISO forms first, then the fixed formats, of 1/2/2020 the month first unless day_first; else null."""
    slashed = DAY_FIRST + MONTH_FIRST if day_first else MONTH_FIRST + DAY_FIRST
    return _parsed(c, slashed[:2] + DATE_FORMATS + slashed[2:])


def day_first_share(c: Column) -> Column:
    """An aggregate: by how many texts fewer are lost when days come first throughout the column; 0 or less if months may come first."""
    lost = lambda order: F.count(F.when(c.isNotNull() & _parsed(c, order + DATE_FORMATS).isNull(), 1))
    return lost(MONTH_FIRST) - lost(DAY_FIRST)


def digit_text(c: Column) -> Column:
    """The 27 digits of |c| from 10^18 to 10^-8, from its shortest decimal form; digits beyond are cut off, not rounded."""
    d = F.abs(c.cast("double")).try_cast("decimal(38,18)")
    whole = F.floor(d)
    part = ((d - whole) * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(18,0)")
    return F.concat(F.right(F.lpad(whole.cast("string"), 19, "0"), F.lit(19)), F.substring(F.lpad(part.cast("string"), 18, "0"), 1, 8))


def digit(c: Column, exponent: int) -> Column:
    """Digit of |c| at 10^exponent; 0 for null."""
    return F.coalesce(F.substring(digit_text(c), HIGHEST_DIGIT - exponent + 1, 1).cast("int"), F.lit(0))


def datetime_parts(c: Column) -> dict[str, Column]:
    """year to second and three digits of milliseconds of a timestamp; 0 for null."""
    micros = F.pmod(F.unix_micros(c.cast("timestamp")), F.lit(1_000_000))
    out = {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c), "minute": F.minute(c), "second": F.second(c)}
    out |= {f"ms_E{e}": F.floor(micros / (10 ** (3 + e))) % 10 for e in (2, 1, 0)}
    return {k: F.coalesce(v.cast("int"), F.lit(0)) for k, v in out.items()}


def char_at(c: Column, i: int) -> Column:
    """Character i (from 0) of a text, the pad behind its end."""
    got = F.substring(c, i + 1, 1)
    return F.when(F.coalesce(got, F.lit("")) == "", PAD).otherwise(got)


def half_even(c: Column) -> Column:
    """Rounded to whole numbers, halves to the even one."""
    return F.rint(c).cast("long")


def saturated(c: Column) -> Column:
    """A double as a long, clipped to its range."""
    return F.when(c >= float(2**63), F.lit(2**63 - 1)).when(c <= -float(2**63), F.lit(-(2**63))).otherwise(c.try_cast("long"))


def clamp(c: Column, low: Column, high: Column) -> Column:
    """c within [low, high]; null stays null, a null bound doesn't bind."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, high), low))


def clipped_day(year: Column, month: Column, day: Column) -> Column:
    """day, but not beyond the end of the month."""
    return F.least(day, F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1)))))


def assembled_datetime(parts: dict[str, Column]) -> Column:
    """The timestamp of year, month, day and, where given, the other parts; days are clipped to the month."""
    get = lambda k: parts.get(k, F.lit(0))
    ms = sum((get(f"ms_E{e}") * 10**e for e in (2, 1, 0)), F.lit(0))
    second = get("second").cast("decimal(16,6)") + (ms / 1000).cast("decimal(16,6)")
    return F.make_timestamp(parts["year"], parts["month"], clipped_day(parts["year"], parts["month"], parts["day"]), get("hour"), get("minute"), second)


def assembled_chars(chars: list[Column]) -> Column:
    """The text of single characters, pads and white space at the end left out."""
    return F.rtrim(F.concat(*[F.when(c == PAD, "").otherwise(c) for c in chars]))


def log2_bucket(c: Column) -> Column:
    """Bucket 0 to 127 of a number by sign and power of two: 64 holds [0, 1), 65 [1, 2), 63 [-1, 0), 62 [-2, -1)."""
    up = F.lit(65) + F.floor(F.log2(F.when(c >= 1, c)))
    down = F.lit(63) - F.ceil(F.log2(-F.when(c < -1, c)))
    return F.greatest(F.least(F.when(c >= 1, up).when(c >= 0, 64).when(c >= -1, 63).otherwise(down), F.lit(127)), F.lit(0)).cast("int")


def bucket_bounds(i: int) -> tuple[float, float]:
    """Lower and upper bound of a bucket of log2_bucket."""
    if i == 64:
        return 0.0, 1.0
    if i == 63:
        return -1.0, -0.0
    return (2.0 ** (i - 65), 2.0 ** (i - 64)) if i > 64 else (-(2.0 ** (63 - i)), -(2.0 ** (62 - i)))
