"""Declared data checks. A check passes when it finds no failing row."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Check(NamedTuple):
    kind: str
    table: str
    column: str
    parent_table: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        tail = f"_in_{self.parent_table}_{self.parent_column}" if self.parent_table else ""
        return f"{self.kind}_{self.table}_{self.column}{tail}"


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, c) for c in columns]


def unique(table: str, column: str) -> Check:
    return Check("unique", table, column)


def relationship(table: str, column: str, parent_table: str, parent_column: str) -> Check:
    return Check("relationships", table, column, parent_table, parent_column)


# The declared checks, 29 column checks and one assertion.
DECLARED = (
    *not_null("stg_workflow_runs", "workflow_run_id", "status"),
    unique("stg_workflow_runs", "workflow_run_id"),
    *not_null("stg_jobs", "job_id", "workflow_run_id"),
    unique("stg_jobs", "job_id"),
    relationship("stg_jobs", "workflow_run_id", "stg_workflow_runs", "workflow_run_id"),
    *not_null("stg_steps", "job_id", "step_number"),
    relationship("stg_steps", "job_id", "stg_jobs", "job_id"),
    *not_null("stg_failed_logs", "workflow_run_id", "job_id"),
    *not_null("int_failure_events", "job_id", "workflow_run_id"),
    *not_null("fct_workflow_runs", "workflow_run_id"),
    unique("fct_workflow_runs", "workflow_run_id"),
    *not_null("fct_step_executions", "job_id", "step_number"),
    *not_null("fct_actionable_failures", "job_id"),
    *not_null("dim_repositories", "workflow_name"),
    *not_null("dim_commits", "head_sha"),
    *not_null("dim_error_categories", "failure_reason"),
    unique("dim_error_categories", "failure_reason"),
    *not_null(
        "error_classification_rules", "error_pattern", "category", "assigned_team", "priority", "recommended_fix"
    ),
    unique("error_classification_rules", "error_pattern"),
    Check("no_success_classified", "fct_actionable_failures", "job_id", "fct_step_executions", "job_id"),
)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One pass over the table, one result row per column: (column_name, failures)."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counted.select(F.expr(f"stack({len(columns)}, {pairs}) as (column_name, failures)"))


def watched(df: DataFrame, table: str, checks: tuple[Check, ...] = DECLARED) -> tuple[DataFrame, Observation | None]:
    """``df`` as it is, and the NULLs of a table's not-null columns, counted by whatever action reads it next.

    So a table is checked while it is written. Where a lost executor makes Spark repeat a part, failures may be counted
    twice, but never missed.
    """
    columns = [c.column for c in checks if c.kind == "not_null" and c.table == table]
    if not columns:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), seen


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count. NULL keys are ignored."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows. NULL child keys are ignored."""
    # both sides are reduced to one row per key before they meet, so a frequent key costs nothing
    keys = child.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


def classified_successes(steps: DataFrame, failures: DataFrame) -> DataFrame:
    """Classified failures whose step succeeded."""
    log = steps.select(
        "job_id", "step_number", "step_name", "step_status", "step_conclusion", "step_started_at", "step_completed_at"
    )
    succeeded = F.lit(False)
    for state in ("step_status", "step_conclusion"):
        succeeded = succeeded | (F.lower(F.coalesce(state, F.lit(""))) == "success")
    found = failures.select(
        "job_id", "step_number", "workflow_run_id", "failure_reason", "category", "assigned_team", "recommended_fix"
    )
    return log.filter(succeeded).join(found, ["job_id", "step_number"])


def _labelled(check: Check, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(check.name).alias("check_name"),
        F.lit(check.kind).alias("check_kind"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.col("failures"),
    )


def _count(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    table = tables[check.table]
    if check.kind == "unique":
        return duplicates(table, [check.column]).agg(F.count("*").alias("failures"))
    if check.kind == "relationships":
        missing = orphans(table, check.column, tables[check.parent_table], check.parent_column)
        return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
    if check.kind == "no_success_classified":
        return classified_successes(tables[check.parent_table], table).agg(F.count("*").alias("failures"))
    raise ValueError(f"unknown check kind {check.kind!r}")


def run_suite(
    tables: dict[str, DataFrame], checks: tuple[Check, ...] = DECLARED, nulls: dict[str, dict[str, int]] | None = None
) -> DataFrame:
    """All checks as one result table: check_name, check_kind, table_name, column_name, failures, status.

    ``nulls`` are the counts by table and column that :func:`watched` writes gave; these tables need no scan for them. The
    not-null checks of any other table share one. Pass written tables rather than long plans: every other check reads its
    table once more, though only the columns it names.
    """
    parts, nulls = [], nulls or {}
    known = [(c.name, c.kind, c.table, c.column, nulls[c.table][c.column]) for c in checks if c.kind == "not_null" and c.table in nulls]
    if known:
        schema = "check_name string, check_kind string, table_name string, column_name string, failures bigint"
        parts.append(next(iter(tables.values())).sparkSession.createDataFrame(known, schema))
    for name in dict.fromkeys(c.table for c in checks if c.kind == "not_null" and c.table not in nulls):
        columns = [c.column for c in checks if c.kind == "not_null" and c.table == name]
        counts = null_counts(tables[name], columns)
        parts.append(
            counts.select(
                F.concat(F.lit(f"not_null_{name}_"), "column_name").alias("check_name"),
                F.lit("not_null").alias("check_kind"),
                F.lit(name).alias("table_name"),
                "column_name",
                "failures",
            )
        )
    parts += [_labelled(c, _count(c, tables)) for c in checks if c.kind != "not_null"]
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def envelope_counts(envelopes: DataFrame) -> DataFrame:
    """Stated against actual record count of each landed envelope, without exploding it."""
    stated = F.variant_get("envelope", "$.record_count", "bigint")
    actual = F.size(F.variant_get("envelope", "$.data", "array<variant>")).cast("bigint")
    return envelopes.select(
        "source_file_name",
        stated.alias("record_count"),
        actual.alias("data_count"),
        F.coalesce(stated == actual, F.lit(False)).alias("matches"),
    )


def split_malformed(lines: DataFrame, text: str, parsed: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(rows whose JSON text parses, with the VARIANT added; rows to quarantine, unchanged)."""
    tried = lines.withColumn(parsed, F.try_parse_json(text))
    return tried.filter(F.col(parsed).isNotNull()), tried.filter(F.col(parsed).isNull()).drop(parsed)


def oversized(rules: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows breaking the declared text lengths: (column_name, failures)."""
    counted = rules.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    pairs = ", ".join(f"'{c}', `{c}`" for c in limits)
    return counted.select(F.expr(f"stack({len(limits)}, {pairs}) as (column_name, failures)"))
