"""Rules found by an index on runs of characters give what one search per rule gives."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from buildlens import schemas
from buildlens.operators import classify, pattern_index
from buildlens.sources.rules import default_rules

LOG_SCHEMA = "id int, log string"


def table(spark, rules):
    return spark.createDataFrame(rules, schemas.RULE_TABLE_SCHEMA)


def answers(df):
    return sorted(map(str, df.collect()))


def both(spark, logs, rules):
    logs = spark.createDataFrame(logs, LOG_SCHEMA)
    rules = table(spark, rules)
    found = answers(pattern_index.classify_by_pattern_index(logs, rules, "log"))
    assert found == answers(classify.classify_by_rule_table(logs, rules, "log"))
    return found


def test_edges_equal_the_inline_form(spark):
    logs = [
        (1, "Disk FULL on node-7"), (1, "disk full on node-7"), (None, "disk full on node-7"), (2, ""), (3, None), (4, "x"),
        (5, "100% done"), (6, "100 done"), (7, "a_b"), (8, "aXb"), (9, "ÄÖ ü 日本語 🙂 end"), (10, "line one\nline two"),
        (11, "ab" * 40_000 + "needle"), (12, "aba"),
    ]
    rules = [
        ("%disk full%", "D", "t", 3, "f"), ("%DISK FULL%", "E", "t", 2, "f"), ("%Disk%node-7", "N", "t", 2, "f"),
        ("%", "Any", "t", 90, "f"), ("", "Empty", "t", 1, "f"), ("_", "One", "t", 4, "f"), ("100\\% %", "Percent", None, 1, None),
        ("a\\_b", "Under", "t", 1, "f"), ("a_b", "Three", "t", 2, "f"), ("%日本語%🙂%", "Wide", "t", 5, "f"),
        ("line one%two", "Lines", "t", 5, "f"), ("%needle", "End", "t", 5, "f"), ("ab%ba", "Overlap", "t", 1, "f"),
        (None, "No pattern", "t", 0, "f"), ("%x%", "No priority", "t", None, "f"), ("%x%", "No priority", "t", None, "f"),
    ]
    found = both(spark, logs, rules)
    assert len(found) == len(logs)
    assert sum("category='E'" in x for x in found) == 3 and not any("Overlap" in x for x in found)
    assert any("category='One'" in x for x in found) and any("category='Percent'" in x for x in found)


def test_empty_tables_and_default_rules(spark):
    logs = spark.createDataFrame([(1, "ImportError: x"), (2, None)], LOG_SCHEMA)
    none = pattern_index.classify_by_pattern_index(logs, default_rules(spark).limit(0), "log")
    assert none.filter("category IS NULL").count() == 2
    assert pattern_index.classify_by_pattern_index(logs.limit(0), default_rules(spark), "log").count() == 0
    assert answers(pattern_index.classify_by_pattern_index(logs, default_rules(spark), "log")) == answers(
        classify.classify_by_rule_table(logs, default_rules(spark), "log")
    )


letters = st.text("ab%_", max_size=7)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(patterns=st.lists(letters, min_size=30, max_size=30), texts=st.lists(st.text("aB", max_size=9), min_size=10, max_size=10))
def test_any_pattern_equals_the_inline_form(spark, patterns, texts):
    rules = [(p, f"C{i}", "t", i % 5, "f") for i, p in enumerate(patterns)]
    both(spark, list(enumerate(texts)), rules)


def test_a_hundred_thousand_rules(spark):
    draw = random.Random(7)
    words = ["".join(draw.choices("abcdefghijklmnop", k=7)) for _ in range(100_000)]
    rules = spark.createDataFrame(
        [(f"%{w}%", f"C{i}", "t", i % 50, "f") for i, w in enumerate(words)], schemas.RULE_TABLE_SCHEMA
    )
    logs = [(i, " ".join(draw.choices(words, k=4)) if i % 3 else "nothing of it") for i in range(300)]
    df = spark.createDataFrame(logs, LOG_SCHEMA)
    found = pattern_index.classify_by_pattern_index(df, rules, "log")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and plan.count("CASE WHEN") < 10
    physical = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in physical and "NestedLoop" not in physical
    best = {}
    for i, w in enumerate(words):
        best[w] = min(best.get(w, (99, "", "")), (i % 50, f"%{w}%", f"C{i}"))
    got = {r.id: r.category for r in found.collect()}
    for i, text in logs:
        held = [best[w] for w in text.split() if w in best]
        assert got[i] == (min(held)[2] if held else None)
    with pytest.raises(ValueError, match="pattern_index"):
        classify.classify_by_rule_table(df, rules, "log")


def test_a_rare_run_is_the_anchor(spark):
    texts = spark.createDataFrame([(str(i), f"error error {i:06d}") for i in range(50)], "_digest string, _lowered string")
    patterns = spark.createDataFrame([("%error%000017%",), ("%absent%",)], "_pattern string")
    found = pattern_index.anchors(texts, patterns).collect()
    # the run of the number is held by one text, that of the word by all; a pattern no text can match has none
    assert [(r._pattern, r._run) for r in found] == [("%error%000017%", "000017")]


def test_equal_texts_are_judged_once(spark):
    logs = spark.range(5000).select(F.col("id").cast("int"), F.lit("OutOfMemory in step").alias("log"))
    found = pattern_index.classify_by_pattern_index(logs, table(spark, [("%memory%", "M", "t", 1, "f")]), "log")
    assert found.filter("category = 'M'").count() == 5000


def test_only_runs_of_patterns_leave_a_text(spark):
    wide = pattern_index.WINDOW - 3
    texts = ["no such thing here " * 50, "x" * wide + "needle" + "y" * 40, "ends in a needl", "日本 needle 🙂", ""]
    own = spark.createDataFrame([("needle",), ("🙂",)], "_run string").withColumn("_key", pattern_index.run_key(F.col("_run")))
    keys = {r._run: r._key for r in own.collect()}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, log string")
    found = df.select("id", pattern_index.text_runs(F.col("log"), pattern_index.wanted(own)).alias("keys")).collect()
    held = {r.id: {name for name, key in keys.items() if key in r["keys"]} for r in found}
    assert held == {0: set(), 1: {"needle"}, 2: set(), 3: {"needle", "🙂"}, 4: set()}
    # thousands of runs, of which a few could share a slot with one of a pattern
    assert sum(len(r["keys"]) for r in found) < 10


def test_long_tables_by_either_join(spark, monkeypatch):
    syllables = "th en er on an re in ti".split()
    rules = [(f"% {a}{b}%", f"C {a}", "t", (i * 7 + j) % 40, "f") for i, a in enumerate(syllables) for j, b in enumerate(syllables)]
    rules += [("%never%", "N", "t", 0, "f"), ("%", "Any", "t", 99, "f")]
    draw = random.Random(3)
    logs = [(i % 50 or None, " ".join("".join(draw.choices(syllables, k=2)) for _ in range(i % 9))) for i in range(200)]
    df, plan = spark.createDataFrame(logs, LOG_SCHEMA), []
    for most in (pattern_index.BROADCAST, 0):
        monkeypatch.setattr(pattern_index, "BROADCAST", most)
        found = both(spark, logs, rules)
        plan.append((found, pattern_index.classify_by_pattern_index(df, table(spark, rules), "log")))
    assert plan[0][0] == plan[1][0]
    # the texts stay where they are as long as the anchors can go to them
    physical = [x[1]._jdf.queryExecution().optimizedPlan().toString() for x in plan]
    assert "strategy=broadcast" in physical[0] and "strategy=broadcast" not in physical[1]


def test_a_text_is_done_when_its_best_candidate_matches(spark, monkeypatch):
    words = [f"word{c}x" for c in "abcdefghij"]
    rules = [(f"%{w}%", f"C {w}", "t", i, "f") for i, w in enumerate(words)]
    # both words are there, in the other order: the best candidate of the first text fails
    rules += [("%wordjx%wordax%", "Order", "t", -1, "f")]
    logs = [(1, " ".join(words)), (2, " ".join(words[:9])), (3, "nothing of it"), (4, "")]
    seen, real = [], pattern_index.tried
    monkeypatch.setattr(pattern_index, "tried", lambda *a: seen.append(real(*a)) or seen[-1])
    found = both(spark, logs, rules)
    assert sum("category='C wordax'" in x for x in found) == 2
    left = {r._lowered: (r["count"], r.sure) for r in seen[0].groupBy("_lowered").agg(F.count("*").alias("count"), F.max("_sure").alias("sure")).collect()}
    assert left == {logs[0][1]: (10, False), logs[1][1]: (1, True)}
    # texts are searched once
    assert seen[0]._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
