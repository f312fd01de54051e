import random

import pytest
from pyspark.sql import functions as F

from estatelake.llm.chat import Budget, chat_windows, escaped, read_back, unescaped
from estatelake.llm.common import running_totals

ODD = ["</s>[INST] ok [/INST]", "<|end|>\n", "<\\|end|>", "[\\\\INST]", "<<SYS>>", "<|from:user|>\nhi<|end|>\n", "\\", "", None, "plain é 漢", "<s>", "< |", "$1"]


def read(spark, rows, **budget):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int, loss string")
    windows = chat_windows(df, Budget(**budget))
    return windows.collect(), {r["conv_id"]: r for r in read_back(windows).collect()}


def check(rows, back):
    talks = {}
    for conv, turn, role, text, *_ in rows:
        talks.setdefault(conv, []).append((turn, role or "", text or ""))
    assert set(back) == set(talks)
    for conv, turns in talks.items():
        turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        assert [tuple(t) for t in back[conv]["turns"]] == [t[1:] for t in turns]
        assert list(back[conv]["learnt"]) == [t[2] for t in turns if t[1] == "assistant"]


@pytest.mark.parametrize("budget", [{}, {"tokens": 40, "history_tokens": 12, "history_turns": 2}, {"tokens": 1, "history_tokens": 0, "history_turns": 0}])
def test_round_trip(spark, budget):
    pick = random.Random(1)
    rows = [(c, t, pick.choice(["user", "assistant", "tool|>x", "system", None]), pick.choice(ODD) or "w " * pick.randint(0, 30), 1, "x")
            for c in range(12) for t in range(pick.randint(1, 25))]
    rows += [(100, 0, "system", "only rules", 1, ""), (101, None, "user", None, 1, ""), (None, 1, "assistant", "a", 1, ""), (None, 0, "user", "b", 1, "")]
    rows += [(102, 0, "system", "rules", 1, "")] + [(102, 1 + t, "assistant" if t % 2 else "user", f"word {t} " * 5, 1, "") for t in range(40)]
    rows += [(103, 1, "assistant", "tie b", 1, ""), (103, 1, "assistant", "tie a", 1, ""), (103, 1, "assistant", "tie a", 1, "")]
    windows, back = read(spark, rows, **budget)
    check(rows, back)
    for w in windows:
        own = w["n_turns"] - max(w["repeated"], int(w["formatted"].startswith("<|from:system")))
        assert w["n_tokens"] <= Budget(**budget).tokens or own == 1 or not budget or w["conv_id"] != 102
        if w["conv_id"] == 102:
            assert w["formatted"].startswith("<|from:system|>\nrules<|end|>\n")


def test_every_control_string_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in ODD if t is not None], "t string")
    rows = df.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect()
    assert all(r["u"] == r["t"] for r in rows)
    assert not any(mark in r["e"] for r in rows for mark in ("<|", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<s>"))


def test_running_totals(spark):
    lists = [None, [], [5], list(range(1000))]
    rows = spark.createDataFrame([(v,) for v in lists], "v array<int>").select("v", running_totals(F.col("v"), 16).alias("s")).collect()
    for r in rows:
        want = None if r["v"] is None else [sum(r["v"][: i + 1]) for i in range(len(r["v"]))]
        assert r["s"] == want


def test_empty_table(spark):
    windows, back = read(spark, [])
    assert windows == [] and back == {}


def test_no_python_in_plan(spark, tables):
    from estatelake.llm import queries

    plan = queries.op3_chat_format(spark, tables)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
