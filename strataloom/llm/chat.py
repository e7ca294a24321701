"""Chat formatting: a declarative template, a finite-state check of the turn order, loss flags per segment.

All steps are DataFrame functions. A conversation is one training example, so its turns meet in one row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles are learned, and which orders of roles are valid.

    Every marker starts with "<" or "["; `escapes` keeps both out of texts, so a text can never
    hold a marker. `role_escapes` keeps the first character of open_right out of roles; it is looked
    for behind open_left only. The escapes apply in the order given and are undone in the reverse order.
    """

    open_left: str = "<|"
    open_right: str = "|>\n"
    close: str = "<|end|>\n"
    learn: tuple[str, ...] = ("assistant",)
    escapes: tuple[tuple[str, str], ...] = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
    role_escapes: tuple[tuple[str, str], ...] = (("|", "&#124;"),)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    #: (state, role): next state; anything else leads to "invalid" for good.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )

    def escape(self, c: Column, role: bool = False) -> Column:
        for plain, coded in self.escapes + self.role_escapes * role:
            c = F.replace(c, F.lit(plain), F.lit(coded))
        return c

    def unescape(self, c: Column, role: bool = False) -> Column:
        for plain, coded in reversed(self.escapes + self.role_escapes * role):
            c = F.replace(c, F.lit(coded), F.lit(plain))
        return c


def format_chats(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments (text, learn), state, valid.

    rows: conv_id, turn, role, text in any order; other columns are ignored. Turns are ordered by
    (turn, role, text), nulls first; a null role or text is empty; repeated rows are all kept.
    An invalid order is reported (valid false) and still formatted. No row is dropped.
    """
    t = template or Template()
    moves = F.create_map(*[F.lit(x) for (state, role), to in t.moves.items() for x in (f"{state}\n{role}", to)])
    turns = rows.select("conv_id", F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def parts(x: Column) -> Column:
        piece = lambda text, learn: F.struct(text.alias("text"), learn.alias("learn"))
        return F.array(
            piece(F.concat(F.lit(t.open_left), t.escape(x.role, True), F.lit(t.open_right)), F.lit(False)),
            piece(t.escape(x.text), x.role.isin(*t.learn)),
            piece(F.lit(t.close), F.lit(False)),
        )

    step = lambda s, x: F.coalesce(F.try_element_at(moves, F.concat(s, F.lit("\n"), x.role)), F.lit("invalid"))
    out = turns.select("conv_id", F.flatten(F.transform("turns", parts)).alias("segments"), F.aggregate("turns", F.lit(t.start), step).alias("state"))
    return out.select("conv_id", F.concat_ws("", "segments.text").alias("formatted"), "segments", "state", F.col("state").isin(*t.accept).alias("valid"))


def read_chats(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Undo format_chats: conv_id, formatted, turns (role, text), learned (all text under the loss mask).

    chats: what format_chats returns; other columns are ignored. Nulls came in as empty texts and
    come back as such. An empty table gives an empty one.
    """
    t = template or Template()
    pieces = F.split("formatted", _literal(t.close))
    # a role that starts like the rest of open_right makes one together with the end of open_left
    at = lambda p: F.locate(t.open_right, p, len(t.open_left) + 1)
    turn = lambda p: F.struct(
        t.unescape(F.substring(p, F.lit(len(t.open_left) + 1), at(p) - len(t.open_left) - 1), True).alias("role"),
        t.unescape(F.substring(p, at(p) + len(t.open_right), F.length(p))).alias("text"),
    )
    masked = F.transform(F.filter("segments", lambda s: s.learn), lambda s: s.text)
    return chats.select("conv_id", "formatted", F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn).alias("turns"), t.unescape(F.concat_ws("", masked)).alias("learned"))


def _literal(s: str) -> str:
    """A regular expression that matches just s."""
    return "\\Q" + s + "\\E"


CONTROL = "</s>[INST] ok [/INST]"


def op6_chat(spark, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one (-1) that says control strings, read back from the formatted output.

    The planted conversation is formatted by itself, so one of the table with the same number stays as it is.
    """
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    chats = format_chats(rows).unionByName(format_chats(extra))
    back = read_chats(chats)
    said = F.concat_ws("", F.transform("turns", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES = {"op6_chat": op6_chat}
ORACLES = {
    "op6_chat": """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, 0 AS planted FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 1
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 1)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(13 + length(role) + 4 * (length(role) - length(replace(role, '&', ''))) + 3 * (length(role) - length(replace(role, '<', ''))) + 4 * (length(role) - length(replace(role, '[', ''))) + 5 * (length(role) - length(replace(role, '|', '')))
    + length(text) + 4 * (length(text) - length(replace(text, '&', ''))) + 3 * (length(text) - length(replace(text, '<', ''))) + 4 * (length(text) - length(replace(text, '[', '')))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id, planted""",
}
