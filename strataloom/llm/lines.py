"""Line dedup by an exact set-similarity join over the words of lines. DataFrame functions only.

A line is the set of its words, ordered by rarity: by the magnitude of a count over all documents,
kept for WORD_CLASSES classes of words, then by hash. Two sets with a Jaccard similarity of t or
more share a word among the first of each in that order (prefix filter). Length, position and a
parity sketch of the whole set thin the candidates, whose words are then compared. Equal sets are
one before the join, so copies of a line add no pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.common import WORD, forget, stored

#: Classes of words, by hash, that are counted: bounds the table that every task sees, a byte a class.
WORD_CLASSES = 1 << 20
#: Sets of a word of this magnitude or more are dealt to tasks of about 2^FREQUENT rows when they meet the earliest, and stand apart by size when they meet all.
FREQUENT = 14
#: Sets of fewer words have a sketch of 64 bits, others of 128.
SHORT = 40
#: The words of prefixes are shuffled and joined in so many turns: bounds the disk that the join takes.
TURNS = 2
#: Bits a key, and at most, of the table that tells which documents a later step needs: bounds what is broadcast.
MARK_BITS, MARKS = 64, 1 << 26
#: How far before a set, among those of a word, the sets stand that it meets besides the earliest: only in large groups.
BESIDE = (5, 12)


def _lowered(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), low: the text in lower case, its white space but line ends as blanks."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.lower(text).alias("low"))
    other = reduce(Column.__or__, [F.contains("low", F.lit(c)) for c in "\t\x0b\x0c\r"])
    return rows.withColumn("low", F.when(other, F.translate("low", "\t\x0b\x0c\r", "    ")).otherwise(F.col("low")))


def _hashes(line: str) -> Column:
    """64-bit hashes of the words of a lowered line, each once."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def magnitudes(docs: DataFrame) -> bytes:
    """For each class of words the base-2 magnitude of its count over all documents, and 1: WORD_CLASSES bytes."""
    words = _lowered(docs).select(F.explode(F.split(F.replace("low", F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    counts = words.groupBy(F.when(F.col("w") != "", F.xxhash64("w").bitwiseAND(WORD_CLASSES - 1)).alias("class")).count().where("class is not null")
    # the classes of a part, 4,096 or fewer, come to the driver as one row
    parts = counts.groupBy(F.shiftright("class", 12).alias("part")).agg(F.collect_list(F.struct(F.col("class").bitwiseAND(4095).cast("int").alias("at"), (1 + F.least(F.floor(F.log2("count")), F.lit(60))).cast("int").alias("m"))).alias("own"))
    out = bytearray(b"\1" * WORD_CLASSES)
    for r in parts.select("part", F.col("own.at").alias("at"), F.col("own.m").alias("m")).toLocalIterator():
        for i, m in zip(r.at, r.m, strict=True):
            out[(r.part << 12) + i] = m
    return bytes(out)


def shares(n: Column, percent: int) -> tuple[Column, Column]:
    """How many of the first words of a set of n can be the first shared with a shorter set, and with one as long or longer."""
    return n - F.floor((percent * n + 99) / 100) + 1, n - F.floor((2 * percent * n + 99 + percent) / (100 + percent)) + 1


def line_sets(docs: DataFrame, magnitude: bytes, percent: int) -> DataFrame:
    """A row per line with words: doc_id, th, line, s1, s2 (name of its set), n, prefix (its rarest words), whole, odd (its parity sketch: of all words, and of the odd half of them in sets of SHORT words or more).

    A word is a number that sorts by rarity: the magnitude of its class, then 57 bits of its hash.
    """
    table = F.lit(magnitude)

    def word(h: Column) -> Column:
        m = F.ascii(F.substring(table, h.bitwiseAND(WORD_CLASSES - 1).cast("int") + 1, F.lit(1)).cast("string"))
        return F.shiftleft(m.cast("long"), 57).bitwiseOR(F.shiftrightunsigned(h, 7))

    def parity(bit: Callable[[Column], Column]) -> Column:
        return F.aggregate("words", F.lit(0).cast("long"), lambda acc, w: acc.bitwiseXOR(F.call_function("shiftleft", bit(w), w.bitwiseAND(63).cast("int"))))

    lines = _lowered(docs).select("doc_id", "th", F.posexplode(F.split("low", "\n")).alias("line", "low")).where(F.length(F.trim("low")) > 0)
    rows = lines.select("doc_id", "th", "line", _hashes("low").alias("hashes"))
    rows = rows.select("doc_id", "th", "line", F.sort_array(F.transform("hashes", word)).alias("words"))
    n, whole = F.size("words"), parity(lambda w: F.lit(1).cast("long"))
    odd = F.when(n >= SHORT, parity(lambda w: F.shiftright(w, 6).bitwiseAND(1))).otherwise(F.lit(0).cast("long"))
    rows = rows.select("doc_id", "th", "line", F.xxhash64("words").alias("s1"), F.xxhash64(F.lit(7), "words").alias("s2"), n.alias("n"), F.slice("words", 1, F.when(n > 1, shares(n, percent)[0]).otherwise(0).cast("int")).alias("prefix"), whole.alias("whole"), odd.alias("odd"))
    return rows.select("doc_id", "th", "line", "s1", "s2", "n", "prefix", "whole", "odd")


def prefix_rows(sets: DataFrame) -> DataFrame:
    """A row per set and word of its prefix: word, age, at (size, place, and 1 if chosen, in one number), whole, odd. sets: age, n, prefix, whole, odd, chosen (0 or 1)."""
    rows = sets.where("n > 1").select("age", "n", "chosen", "whole", "odd", F.posexplode("prefix").alias("place", "word"))
    at = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.shiftleft(F.col("place").cast("long"), 1)).bitwiseOR(F.col("chosen").cast("long"))
    return rows.select("word", "age", at.alias("at"), "whole", "odd")


def near(x: str, y: str, percent: int) -> Column:
    """Whether rows x and y of one word can be of similar sets: by length, position, and how far their sketches differ."""
    c = lambda side, name: F.col(f"{side}.{name}")
    n = lambda side: F.shiftright(c(side, "at"), 32)
    place = lambda side: F.shiftright(c(side, "at"), 1).bitwiseAND((1 << 31) - 1)
    nx, ny, px, py = n(x), n(y), place(x), place(y)
    both = F.floor((percent * (nx + ny) + 99 + percent) / (100 + percent))
    most = F.least(px, py) + F.least(nx - px, ny - py)
    odd, whole = c(x, "odd").bitwiseXOR(c(y, "odd")), c(x, "whole").bitwiseXOR(c(y, "whole"))
    # a bit that differs stands for a word that one set lacks; of two long sets, the odd and the other words have 64 bits each
    apart = F.when((nx >= SHORT) & (ny >= SHORT), F.bit_count(odd) + F.bit_count(whole.bitwiseXOR(odd))).otherwise(F.bit_count(whole))
    short = F.when(nx <= ny, px < shares(nx, percent)[1]).otherwise(py < shares(ny, percent)[1])
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & (apart <= nx + ny - 2 * both) & (most >= both) & short


def _magnitude(word: Column) -> Column:
    return F.shiftright(word, 57)


def first_candidates(sets: DataFrame, percent: int) -> DataFrame:
    """(later, earlier): each set with the earliest set of each word of its prefix and those BESIDE it (of a share of them, for frequent words), where they can be similar.

    So many pairs per row at most, so a group of near copies adds pairs as it grows, not as its square.
    """
    rows = prefix_rows(sets)
    own = F.struct(*[k for k in rows.columns if k != "word"])
    salts = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.lit(0), _magnitude(F.col("word")) - FREQUENT).cast("int"))
    order = Window.partitionBy("word", F.pmod(F.xxhash64("age"), salts)).orderBy("age")
    met = rows.select(own.alias("x"), F.first(own).over(order).alias("y0"), *[F.lag(own, k).over(order).alias(f"y{k}") for k in BESIDE])
    # one within the other: near() is costly, and most sets have no other of a word before them
    hit = lambda y: F.when(F.col(f"{y}.age").isNotNull(), F.when(F.col("x.age") > F.col(f"{y}.age"), F.when(near("x", y, percent), F.col(f"{y}.age"))))
    hits = [f"e{k}" for k in (0, *BESIDE)]
    met = met.select(F.col("x.age").alias("later"), *[hit(f"y{e[1:]}").alias(e) for e in hits]).where(F.coalesce(*hits).isNotNull())
    return met.select("later", F.explode(F.array(*hits)).alias("earlier")).where("earlier is not null")


def all_candidates(rows: DataFrame, percent: int) -> DataFrame:
    """(later, earlier): each chosen set with all sets before it that can be similar. Both sides have the same columns and read one shuffle.

    The sets of a frequent word stand in bands of sizes. Sets that can be similar are of one band or
    of neighbouring ones; each stands in its own and the next, and they meet in the upper one of their own.
    """
    own = F.floor(F.log(F.shiftright("at", 32).cast("double")) / F.log(F.lit(100 / percent))).cast("int")
    rows = rows.withColumn("own", F.when(_magnitude(F.col("word")) >= FREQUENT, own).otherwise(-1))
    rows = rows.withColumn("band", F.explode(F.when(F.col("own") < 0, F.array(F.lit(-1))).otherwise(F.array("own", F.col("own") + 1))))
    same = (F.col("x.word") == F.col("y.word")) & (F.col("x.band") == F.col("y.band")) & (F.col("x.band") == F.greatest("x.own", "y.own"))
    met = rows.alias("x").join(rows.alias("y"), same & (F.col("x.age") > F.col("y.age")) & (F.col("x.at").bitwiseAND(1) == 1) & near("x", "y", percent))
    return met.select(F.col("x.age").alias("later"), F.col("y.age").alias("earlier"))


def marked(docs: DataFrame, th: Column, keys: DataFrame) -> DataFrame:
    """(row, marked): the columns of docs as one struct, and false only for texts whose hash isn't in keys (th, read twice). Reads a bitmap, 4 KB a row, of MARK_BITS bits a key, MARKS at most."""
    bits = min(MARKS, max(1 << 15, 1 << (MARK_BITS * keys.count()).bit_length()))
    bit = lambda c: F.pmod(c, F.lit(bits))
    maps = keys.select(bit(F.col("th")).alias("b")).groupBy(F.bitmap_bucket_number("b").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), bit(th).alias("b"))
    met = rows.join(F.broadcast(maps), F.bitmap_bucket_number("b") == F.col("bucket"), "left")
    at = F.bitmap_bit_position("b")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return met.select("row", F.coalesce(F.get(F.split(F.lpad(F.conv(byte.cast("string"), 10, 2), 8, "0"), ""), (7 - at % 8).cast("int")) == "1", F.lit(False)).alias("marked"))


def verified(docs: DataFrame, names: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(age), stored: the later sets of pairs whose words, read from the documents, are similar enough. names: age, doc_id, th, line."""
    ages = pairs.select(F.explode(F.array("later", "earlier")).alias("age")).distinct()
    wanted = stored(names.select("age", "doc_id", "th", "line").join(ages, "age"), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = marked(texts, F.xxhash64("text"), wanted.select("th")).where("marked").select("row.*")
    lines = _lowered(texts).select("doc_id", "th", F.posexplode(F.split("low", "\n")).alias("line", "low"))
    there = wanted.select("age", F.col("doc_id").alias("id"), F.col("th").alias("t"), F.col("line").alias("l"))
    met = lines.join(there, (F.col("th") == F.col("t")) & (F.col("line") == F.col("l")) & F.col("doc_id").eqNullSafe(F.col("id")))
    words = stored(met.select("age", _hashes("low").alias("words")).dropDuplicates(["age"]), "words")  # repeated rows give equal ones
    one = words.select(F.col("age").alias("later"), F.col("words").alias("wx"))
    two = words.select(F.col("age").alias("earlier"), F.col("words").alias("wy"))
    met = pairs.join(one, "later").join(two, "earlier").withColumn("both", F.size(F.array_intersect("wx", "wy")))
    met = met.where(F.col("both") * 100 >= (F.size("wx") + F.size("wy") - F.col("both")) * percent)
    out = stored(met.select(F.col("later").alias("age")).distinct(), "verified")
    for t in (wanted, words):
        forget(t)
    return out


def named_sets(rows: DataFrame) -> DataFrame:
    """(s1, s2, late, doc_id, th, line, row, age, n, prefix, whole, odd), stored, per set of the stored line_sets: its first line, its place in the order of first lines, and the words of its prefix."""
    at = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "th", "line", "row")
    own = {"n": F.col("n"), "prefix": F.col("prefix"), "whole": F.col("whole"), "odd": F.col("odd")}
    names = rows.groupBy("s1", "s2").agg(F.min(at).alias("at"), *[F.any_value(v).alias(k) for k, v in own.items()])
    names = names.repartitionByRange("at").sortWithinPartitions("at")
    return stored(names.select("s1", "s2", "at.*", F.monotonically_increasing_id().alias("age"), *own), "names")


def later_matches(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, th, line), stored: the lines that match a line before them, by (doc_id, hash of the text, line), null ids last.

    A set's age is its place in the order of first lines. Sets are held against the earliest
    sets of their words first; those that this doesn't remove are held against all sets before them.
    """
    rows = stored(line_sets(docs, magnitudes(docs), percent).withColumn("row", F.monotonically_increasing_id()), "lines")
    names = named_sets(rows)
    pairs = stored(first_candidates(names.withColumn("chosen", F.lit(1)), percent).distinct(), "met")
    gone = verified(docs, names, pairs, percent)
    forget(pairs)
    first = names.join(gone.withColumn("gone", F.lit(1)), "age", "left").select("s1", "s2", "late", *[F.col(c).alias(f"first_{c}") for c in ("doc_id", "th", "line", "row")], "age", F.when(F.col("gone") == 1, 0).otherwise(1).alias("chosen"))
    is_first = F.col("row") == F.col("first_row")
    again = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "th", "line") > F.struct("late", *[F.col(f"first_{c}").alias(c) for c in ("doc_id", "th", "line")])
    sets = rows.join(first, ["s1", "s2"]).select("age", "doc_id", "th", "line", again.alias("again"), "n", F.when(is_first, F.col("prefix")).alias("prefix"), "whole", "odd", "chosen")
    sets = stored(sets, "sets")
    forget(rows)
    rows = prefix_rows(sets.where("prefix is not null"))
    parts = [stored(all_candidates(rows.where(F.col("word").bitwiseAND(TURNS - 1) == k), percent).distinct(), "found") for k in range(TURNS)]
    pairs = stored(reduce(DataFrame.union, parts).distinct(), "candidates")
    more = verified(docs, names, pairs, percent)
    out = gone.union(more).withColumn("gone", F.lit(True))  # a set of the one isn't chosen for the other
    later = sets.select("age", "doc_id", "th", "line", "again").join(out, "age", "left").where("gone or again").select("doc_id", "th", "line")
    later = stored(later, "later")
    for t in (names, sets, gone, more, pairs, *parts):
        forget(t)
    return later


def dedup_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """docs with the lines taken out that match an earlier one, and columns n_lines, n_removed.

    Lines are what "\\n" separates; two match if the Jaccard similarity of their sets of words
    in lower case is percent or more. A line is removed if any line before it matches,
    removed or not, so the result doesn't depend on the order of work. Lines without words always
    stay. Rows equal in doc_id and text are one place: they don't remove each other's lines. A
    null text stays null, with no lines; a null doc_id comes last. An empty table gives an empty
    one. Other columns pass through whatever their names, but columns of docs named n_lines or
    n_removed are replaced. Texts of any length are read whole.
    """
    later = later_matches(docs, percent)
    gone = stored(later.groupBy(F.col("doc_id").alias("id"), F.col("th").alias("t")).agg(F.collect_set("line").alias("gone")), "gone")
    forget(later)
    text = F.col("row.text").cast("string")
    rows = marked(docs, F.xxhash64(F.col("text").cast("string")), gone.select(F.col("t").alias("th")))
    met = rows.where("marked").join(gone, F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("t")), "left").select("row", "gone")
    met = met.unionByName(rows.where("not marked").select("row", F.lit(None).cast("array<int>").alias("gone")))
    met = met.withColumn("lines", F.when(F.col("gone").isNotNull(), F.split(text, "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    out = {"n_lines": F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, "n_removed": F.when(F.col("gone").isNotNull(), F.size("gone"))}
    out = {k: F.coalesce(v, F.lit(0)).cast("long") for k, v in out.items()}
    return met.select(*[kept.alias("text") if c.lower() == "text" else F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in out], *[v.alias(k) for k, v in out.items()])


def drop_repeated_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """docs with repeated lines taken out and n_chars set anew; a document all of whose words went is dropped.

    A document without words before stays as it is; a null text and an empty table stay so too.
    All columns of docs come back, n_lines and n_removed as well if docs has them.
    """
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    out = dedup_lines(whole, percent)
    out = out.where((F.col("n_removed") == 0) | F.col("text").isNull() | F.col("text").rlike(WORD))

    def column(c: str) -> Column:
        if c.lower() == "text":
            return F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("whole.text")).alias(c)
        if c.lower() == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col(f"whole.`{c}`")).alias(c)
        return F.col(f"whole.`{c}`").alias(c)

    return out.select(*[column(c) for c in docs.columns])


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents after line dedup: doc_id, n_lines, n_removed, text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLES: dict[str, str] = {}
