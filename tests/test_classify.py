"""Name rules, the rule table and the batch classifier."""

import os
import re

import pandas as pd
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from buildlens import schemas
from buildlens.operators import classify, quality
from buildlens.plans import refresh
from buildlens.sources.rules import default_rules

EVENTS = "step_name string, workflow_name string, job_name string, failure_reason string, job_id bigint, step_number bigint"


def classified(spark, *data):
    return classify.classify_by_names(spark.createDataFrame(list(data), EVENTS))


def test_rule_order_tag_and_priority(spark):
    found = classified(
        spark,
        ("Pre-Commit Test", "CI", "j", "failure", 1, 1),
        ("unit TESTS", "smoke", "j", "failure", 2, 1),
        ("x", "Lint", "j", "failure", 3, 1),
        ("Smoke", None, None, "failure", 4, 1),
        (None, None, None, None, 5, 1),
        ("x", "CI", "run pre-commit", "failure", 6, 1),
    )
    assert rows(found.select("category", "assigned_team", "classification_source", "priority"), "job_id") == [
        ("Linting & Style Checks", "Core Maintainers", "DETERMINISTIC_RULE", 1),
        ("Unit Test Failure", "Backend Engineering", "DETERMINISTIC_RULE", 1),
        ("Linting & Style Checks", "Core Maintainers", "UNCLASSIFIED_FALLBACK", 2),
        ("Smokeshow / Preview Build Failure", "Frontend / QA", "DETERMINISTIC_RULE", 2),
        ("UNCLASSIFIED_FALLBACK", "Platform Triage", "UNCLASSIFIED_FALLBACK", 2),
        ("Linting & Style Checks", "Core Maintainers", "UNCLASSIFIED_FALLBACK", 2),
    ]


def test_rules_are_matched_once(spark):
    plan = classified(spark, ("a", "b", "c", "d", 1, 1))._jdf.queryExecution().optimizedPlan().toString()
    # three names, each folded once, and each rule's token searched once per name
    assert plan.count("lower(") == 3


LOGS = [
    "ModuleNotFoundError: no module named x",
    "mypy: found 3 errors then stopped with error",
    "ERROR before MYPY FOUND nothing",
    "step timed out; AssertionError",
    "bash: foo: command not found",
    "all good",
    None,
]


def test_rule_table(spark):
    logs = spark.createDataFrame(list(enumerate(LOGS)), "id int, log string")
    found = classify.classify_by_rule_table(logs, default_rules(spark), "log")
    assert rows(found.select("id", "error_pattern", "priority"), "id") == [
        (0, "%ModuleNotFoundError%", 1),
        (1, "%mypy%found%error%", 3),
        (2, None, None),
        (3, "%AssertionError%", 2),
        (4, "%command not found%", 1),
        (5, None, None),
        (6, None, None),
    ]


def test_rule_tables_of_any_length_judge_each_row(spark):
    logs = spark.createDataFrame([(1, "xa"), (1, "xb"), (None, "xb"), (None, None)], "id int, log string")
    wide = [(f"%no{i}%", "N", "T", 0, "F") for i in range(400)]
    some = [("%b%", "B", "T", 1, "F"), ("%a%", "A", "T", 1, "F"), ("%a%", "Z", "T", 1, "F"), (None, "C", "T", 0, "F")]
    for extra in ([], wide):
        rules = spark.createDataFrame(extra + some, schemas.RULE_TABLE_SCHEMA)
        found = classify.classify_by_rule_table(logs, rules, "log")
        assert sorted(map(str, rows(found.select("id", "log", "category")))) == sorted(
            map(str, [(1, "xa", "A"), (1, "xb", "B"), (None, "xb", "B"), (None, None, None)])
        )
        assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert classify.classify_by_rule_table(logs, rules.limit(0), "log").count() == 4


def test_inline_rules_need_no_shuffle(spark):
    logs = spark.createDataFrame(list(enumerate(LOGS)), "id int, log string")
    found = classify.classify_by_rule_table(logs, default_rules(spark), "log")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


pieces = st.text("ab%", max_size=7)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(patterns=st.lists(st.one_of(pieces, st.text("ab%_", max_size=5)), min_size=20, max_size=20))
def test_like_pattern_equals_like(spark, patterns):
    texts = ["", "a", "ab", "ba", "aab", "abab", "bbaa", "abba", "aaaa", "babab"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ours = df.select("t", *[classify.like_pattern(F.col("t"), p).alias(f"c{i}") for i, p in enumerate(patterns)])
    for row in ours.collect():
        for i, pattern in enumerate(patterns):
            regex = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern)
            assert row[i + 1] == bool(re.fullmatch(regex, row.t)), (pattern, row.t)


def failures(spark):
    return classified(
        spark,
        ("deploy", "CI", "j", "failure", 1, 1),
        ("deploy", "CI", "j", "failure", 2, 1),
        ("tests", "CI", "j", "failure", 3, 1),
        (None, "CI", "j", "cancelled", 4, 1),
    )


def test_context_prints_none(spark):
    found = classify.with_context(failures(spark)).filter("job_id = 4").first()
    assert found.failure_context == "Workflow: CI | Step: None | Reason: cancelled"


def test_fallback_asks_once_per_context_and_reuses_answers(spark, tmp_path):
    log = str(tmp_path / "asked")

    def ask(contexts):
        with open(log, "a") as out:
            out.write("".join(c + "\n" for c in contexts))
        return pd.DataFrame({n: contexts + f" {n}" for n in classify.RESULT_FIELDS})

    answers = classify.classify_contexts(classify.pending_contexts(failures(spark)), ask)
    answers.write.parquet(str(tmp_path / "answers"))
    asked = open(log).read().splitlines()
    assert sorted(asked) == ["Workflow: CI | Step: None | Reason: cancelled", "Workflow: CI | Step: deploy | Reason: failure"]
    done = refresh.triage(spark, failures(spark), ask, str(tmp_path / "answers"))
    assert rows(done.select("job_id", "classification_source"), "job_id") == [
        (1, "LLM_FALLBACK"), (2, "LLM_FALLBACK"), (3, "DETERMINISTIC_RULE"), (4, "LLM_FALLBACK"),
    ]
    assert done.filter("job_id = 1").first().category.endswith("category")
    assert len(open(log).read().splitlines()) == 2


def test_a_failing_classifier_fails_the_job(spark, tmp_path):
    def broken(contexts):
        raise RuntimeError("service is down")

    with pytest.raises(Exception, match="service is down"):
        refresh.triage(spark, failures(spark), broken, str(tmp_path / "answers"))


def test_a_spent_quota_ends_the_round_and_the_next_one_goes_on(spark, tmp_path):
    log, answers = str(tmp_path / "asked"), str(tmp_path / "answers")
    rows_ = [(f"step {i}", "CI", "j", "failure", i, 1) for i in range(40)]
    quota = classify.Quota(60_000, lambda e: "429" in str(e), contexts_per_call=3, tasks=2, calls=2)

    def service(most):
        def ask(contexts):
            asked = open(log).read().splitlines() if os.path.exists(log) else []
            if len(asked) + len(contexts) > most:
                raise OSError("429 RESOURCE_EXHAUSTED")
            with open(log, "a") as out:
                out.write("".join(c + "\n" for c in contexts))
            return pd.DataFrame({n: contexts + f" {n}" for n in classify.RESULT_FIELDS})

        return ask

    for most in (0, 20, 21, 100, 100):
        done = refresh.triage(spark, classified(spark, *rows_), service(most), answers, quota=quota)
        asked = open(log).read().splitlines() if os.path.exists(log) else []
        # no answer is lost, none is asked for twice
        assert len(asked) == len(set(asked)) <= most
        found = {r.failure_context for r in spark.read.parquet(answers).collect()}
        assert found == set(asked)
        assert done.filter("classification_source = 'LLM_FALLBACK'").count() == len(asked)
    assert len(asked) == 40 and done.filter("category LIKE '%category'").count() == 40


def test_calls_are_spread_over_the_minute(spark):
    pauses = spark.sparkContext.accumulator(0.0)
    quota = classify.Quota(5, lambda e: False, contexts_per_call=2, tasks=3)
    assert quota.pause == 36 and quota.wave == 30
    contexts = spark.range(0, 12, 1, 1).select(F.col("id").cast("string").alias("failure_context"))
    answers = classify.classify_wave(contexts, classify.offline_classifier(), quota, sleep=pauses.add)
    assert answers.count() == 12 and pauses.value == 6 * 36


def test_retrying():
    calls, pauses = [], []

    def flaky(contexts):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("429")
        return contexts.to_frame()

    ask = classify.retrying(flaky, lambda e: "429" in str(e), sleep=pauses.append)
    assert len(ask(pd.Series(["x"]))) == 1
    assert pauses == [15, 30]
    with pytest.raises(ValueError):
        classify.retrying(lambda c: int("x"), lambda e: False)(pd.Series(["x"]))
    with pytest.raises(RuntimeError, match="2 attempts"):
        classify.retrying(lambda c: 1 / 0, lambda e: True, attempts=2, sleep=pauses.append)(pd.Series(["x"]))


def test_apply_by_key_is_stable_for_repeated_keys(spark):
    results = spark.createDataFrame(
        [(1, 1, "B", "t", "f"), (1, 1, "A", "t", "f"), (9, 9, "C", "t", "f")],
        "job_id bigint, step_number bigint, category string, assigned_team string, recommended_fix string",
    )
    done = classify.apply_classifications(failures(spark), results)
    assert rows(done.select("job_id", "category", "classification_source"), "job_id")[0] == (1, "A", "LLM_FALLBACK")
    assert done.count() == 4 and done.filter("classification_source = 'LLM_FALLBACK'").count() == 1


def test_declared_checks():
    kinds = pd.Series([c.kind for c in quality.DECLARED]).value_counts().to_dict()
    assert kinds == {"not_null": 22, "unique": 5, "relationships": 2, "no_success_classified": 1}
    assert len({c.name for c in quality.DECLARED}) == 30


def test_checks_pass_and_fail(spark):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, s string")
    bad = spark.createDataFrame([(1, None), (1, "x"), (3, "y"), (None, "z")], "id bigint, s string")
    checks = (*quality.not_null("t", "id", "s"), quality.unique("t", "id"), quality.relationship("t", "id", "p", "id"))
    passed = quality.run_suite({"t": good, "p": good}, checks)
    assert {r.status for r in passed.collect()} == {"pass"} and passed.count() == 4
    failed = quality.run_suite({"t": bad, "p": good}, checks)
    assert rows(failed.select("check_kind", "column_name", "failures", "status"), "check_name") == [
        ("not_null", "id", 1, "fail"), ("not_null", "s", 1, "fail"), ("relationships", "id", 1, "fail"), ("unique", "id", 1, "fail"),
    ]
    with pytest.raises(ValueError):
        quality.run_suite({"t": good}, (quality.Check("odd", "t", "id"),))


def test_rule_lengths(spark):
    assert {r.failures for r in quality.oversized(default_rules(spark), schemas.RULE_TABLE_LENGTHS).collect()} == {0}
