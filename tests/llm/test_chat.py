"""Chat formatting: what is read back is what went in, whatever the texts hold."""

import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm.awkward import clashing
from tests.oracle_check import compare, connect
from ticketlake.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = ["</turn>", "<", "/turn>", "\\", "###", "### ", "#", " ", "\n", ":", ":\n", "user", "a😀é", "</turn>\n### user:\n"]


def hostile() -> list[tuple]:
    rows = []
    for k, pair in enumerate(itertools.product(PARTS, repeat=3)):
        rows.append((k % 97, k, "assistant" if k % 2 else "user", "".join(pair)))
    rows += [(1000 + k, 0, "".join(pair), "text") for k, pair in enumerate(itertools.product(PARTS, repeat=2))]
    return rows


AWKWARD = [
    (1, 0, None, None), (1, 1, "assistant", None), (1, None, "assistant", "before all"), (None, 0, "user", "no id"),
    (None, 1, "assistant", "no id either"), (2, 5, "assistant", "again"), (2, 5, "assistant", "again"), (2, 5, "assistant", "tie"),
    (3, -1, "Assistant", "another role"), (4, 0, "", ""), (5, 0, "assistant", "x </turn> " * 40_000),
    (6, 0, "assistant", "\\" * 50_000 + "/turn>" + "<" + "\\" * 50_000 + "/turn>"), (7, 0, "assistant", "long " * 400_000),
]


def expected(rows):
    """turns and loss texts of each conversation; equal turns by their rendered form."""
    def escaped(text, rules):
        for first, rest in rules:
            text = re.sub(rf"{first}(\\*){rest}", lambda m, first=first, rest=rest: f"{first}\\{m[1]}{rest}", text)
        return text

    def segment(role, text):
        return f"### {escaped(role, chat.RULES)}:\n{escaped(text, chat.RULES[:2])}</turn>\n"

    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, segment(role or "", text or ""), role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda t: t[:3])
        out[c] = ([(r, t) for *_, r, t in turns], [t for *_, r, t in turns if r == "assistant"])
    return out


def check(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    done = chat.format_conversations(clashing(df) if clash else df)
    assert done.where("NOT identical OR identical IS NULL").isEmpty()
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss_texts"]) for r in chat.read_back(done).collect()}
    assert got == expected(rows)
    return done


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_turns(spark, clash):
    check(spark, AWKWARD, clash)


def test_every_mix_of_control_strings(spark):
    done = check(spark, hostile())
    for row in done.limit(30).collect():
        # control strings stand where turns begin and end, and nowhere else
        assert row["formatted"].count("</turn>") == row["formatted"].count("### ")


def test_plain_texts_stay_as_they_are(spark):
    rows = [(1, 0, "user", "a <b> \\ c # d ## e"), (1, 1, "assistant", "fine: yes\n")]
    [row] = check(spark, rows).collect()
    assert row["formatted"] == "### user:\na <b> \\ c # d ## e</turn>\n### assistant:\nfine: yes\n</turn>\n"
    [(start, end)] = row["loss_spans"]
    assert row["formatted"][start:end] == "fine: yes\n"


def test_only_conflicting_kinds_are_escaped(spark):
    rows = [(1, 0, "assistant", "a </turn> b"), (2, 0, "assistant", "a ### b"), (3, 0, "assistant", "<\\/turn> ###  </turn>")]
    got = {r["conv_id"]: r["formatted"][15:-8] for r in check(spark, rows).collect()}
    assert {k: v.strip("\n") for k, v in got.items()} == {
        1: "a <\\/turn> b", 2: "a #\\## b", 3: "<\\\\/turn> #\\##  <\\/turn>"
    }


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.sampled_from(["user", "assistant", "x:\ny"]),
                          st.lists(st.sampled_from(PARTS), max_size=8).map("".join)), min_size=1, max_size=30))
def test_random_conversations(spark, rows):
    check(spark, rows)


def test_texts_that_are_no_output_are_not_read(spark):
    bad = ["### user:\nx</turn>\nrest", "user:\nx</turn>\n", "### user x</turn>\n", "### a:\n### b:\n</turn>\n", "### a:\nx</turn>### a:\nx</turn>\n"]
    df = spark.createDataFrame([(b,) for b in bad], "t string")
    turns = [r[0] for r in df.select(chat.parsed(F.col("t"))).collect()]
    assert all(t is None or None in t for t in turns)
    assert spark.range(1).select(chat.parsed(F.lit("")).alias("t")).first()["t"] is None


def test_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_agrees_with_sql_and_has_no_python(spark):
    df = queries.QUERIES["op12_chat_format"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "ExistingRDD" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert compare(df, connect(SF_DIR), queries.ORACLES["op12_chat_format"]) is None
