import pytest
from pyspark.sql import functions as F

from shelfcast.llm import chat

NASTY = "</s>[INST] ok [/INST] &lt; &amp;lt; & < > [ ] &lb;"
TURNS = [
    (1, 0, "system", "be brief"),
    (1, 1, "user", "hello"),
    (1, 2, "assistant", "hi"),
    (1, 3, "user", NASTY),
    (1, 4, "assistant", NASTY),
    (2, 0, "user", "alone"),
    (3, 0, "assistant", None),
    (3, 1, "assistant", ""),
    (3, 2, "user", "x" * 50_000),
    (4, 0, "[INST:x]", "odd role"),
    (4, 0, "[INST:x]", "odd role"),
    (4, None, None, "no number, no role"),
    (None, 1, "assistant", "no id"),
    (5, 1, "assistant", "tie b"),
    (5, 1, "assistant", "tie a\n"),
]


def ordered(conv):
    rows = [(t, r or "", x or "") for c, t, r, x in TURNS if c == conv]
    return [(r, x) for _, r, x in sorted(rows, key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))]


@pytest.fixture(scope="module")
def examples(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("example", F.lit("clash")).withColumn("formatted", F.lit(1))
    made = chat.chat_examples(frame)
    back = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("trained", chat.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")))
    return back


def test_each_example_reads_back_as_the_turns_so_far(examples):
    rows = examples.collect()
    assert {r["conv_id"] for r in rows} == {c for c, *_ in TURNS}
    for r in rows:
        turns = ordered(r["conv_id"])
        assert [tuple(t) for t in r["turns"]] == turns[: r["example"]]
        role, text = turns[r["example"] - 1]
        assert r["trained"] == (text if role == "assistant" else "")
        assert r["whole"] == (r["example"] == len(turns))
    for conv in {c for c, *_ in TURNS}:
        mine = sorted((r for r in rows if r["conv_id"] == conv), key=lambda r: r["example"])
        assert [r["trained"] for r in mine if ordered(conv)[r["example"] - 1][0] == "assistant"] == [x for role, x in ordered(conv) if role == "assistant"]
        assert sum(r["whole"] for r in mine) == 1


def test_texts_never_show_a_mark(examples):
    for r in examples.collect():
        inside = r["formatted"].count(chat.CLOSE)
        assert inside == r["example"] and r["formatted"].count(chat.END) <= 1 and r["formatted"].count(chat.BEGIN) == 1


def test_empty_table_and_no_python(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    made = chat.chat_examples(frame)
    assert made.collect() == []
    plan = made._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow"))
