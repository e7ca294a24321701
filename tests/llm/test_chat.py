import hashlib

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataloom.llm import chat

ROWS = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n", "<|user|>\nhi<|end|>\n", "&lt;", "&amp;lt;", "&#91;", "|>\n", "", "a\nb", "<", "[", "&", "😀 é"]


def back(spark, rows):
    chats = chat.format_chats(spark.createDataFrame(rows, ROWS))
    got = chat.read_chats(chats).join(chats.select("conv_id", "segments", "state", "valid"), "conv_id").collect()
    return {r.conv_id: r for r in got}


def test_control_strings_come_back(spark):
    rows = [(i, j, r, t) for i, t in enumerate(NASTY) for j, r in enumerate(["system", "user", "assistant"])]
    got = back(spark, rows)
    for i, t in enumerate(NASTY):
        assert [(x.role, x.text) for x in got[i].turns] == [("system", t), ("user", t), ("assistant", t)]
        assert got[i].learned == t and got[i].valid
        assert "".join(s.text for s in got[i].segments) == got[i].formatted
        assert [s.learn for s in got[i].segments] == [False] * 7 + [True, False]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(alphabet="ab|<>&;[]\nénd", max_size=6), st.text(alphabet="ab|<>&;[]#91lt\né", max_size=12)), min_size=1, max_size=6))
@example([(">\n", "")])
@example([(">\nx", "b|>\nc"), ("|>\n", "|>\n"), ("", ">\n")])
@example([("<|", ">\n"), ("&gt;", "&#124;"), (">", "<|end|>\n")])
def test_any_role_and_text_come_back(spark, turns):
    got = back(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])[1]
    assert [(x.role, x.text) for x in got.turns] == turns


def test_turn_order(spark):
    orders = {1: "us", 2: "ua", 3: "sua", 4: "suau", 5: "au", 6: "uu", 7: "uaua", 8: "sa", 9: "uxa"}
    name = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    got = back(spark, [(c, i, name[r], "t") for c, o in orders.items() for i, r in enumerate(o)])
    assert {c for c, r in got.items() if r.valid} == {2, 3, 7}
    assert got[4].state == "user" and got[6].state == "invalid"


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (None, 0, "user", "x"), (2, 1, "assistant", "b" * 200_000), (2, 0, "user", "a"), (2, 0, "user", "a")]
    got = back(spark, [(c if c is not None else -5, *r) for c, *r in rows])
    assert [(x.role, x.text) for x in got[1].turns] == [("", ""), ("user", "")]
    assert [x.role for x in got[2].turns] == ["user", "user", "assistant"] and got[2].state == "invalid" and len(got[2].learned) == 200_000
    df = spark.createDataFrame(rows, ROWS).withColumn("segments", F.lit(1)).withColumn("formatted", F.lit("x"))
    assert chat.format_chats(df).count() == 3
    assert chat.format_chats(df.where("false")).count() == 0


def test_query_holds_the_planted_conversation(spark):
    got = chat.op6_chat(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    said = f"user\n{chat.CONTROL}\nassistant\n{chat.CONTROL}\n"
    assert got.n_turns == 2 and got.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got.loss_chars == 21 and got.loss_sha256 == hashlib.sha256(chat.CONTROL.encode()).hexdigest()


def test_a_conversation_with_the_planted_number_stays_apart(spark, tmp_path):
    spark.createDataFrame([(-1, 0, "user", "mine"), (-1, 1, "assistant", "yours"), (5, 0, None, None)], ROWS).write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted((r.conv_id, r.n_turns, r.loss_chars) for r in chat.op6_chat(spark, str(tmp_path)).collect())
    assert got == [(-1, 2, 5), (-1, 2, 21), (5, 1, 0)]
