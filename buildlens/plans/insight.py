"""The questions a triage dashboard asks. Each is a small aggregate or a pruned projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildlens import schemas
from buildlens.functions import scalars
from buildlens.operators.dedupe import top_per_group

# The queue's columns in display order, the drill-down's fields and their defaults.
QUEUE_COLUMNS = ("JOB_ID", "JOB_NAME", "WORKFLOW_NAME", "FAILURE_CATEGORY", "SEVERITY", "ASSIGNED_TEAM",
                 "CLASSIFICATION_SOURCE", "RECOMMENDED_FIX")
DRILLDOWN_DEFAULTS = {
    "JOB_NAME": "Unknown Job",
    "FAILURE_CATEGORY": "Unknown",
    "ASSIGNED_TEAM": "Platform Triage",
    "CLASSIFICATION_SOURCE": "UNKNOWN",
    "RECOMMENDED_FIX": "Inspect logs",
    "ERROR_MESSAGE": "No error captured",
}
FACETS = ("ASSIGNED_TEAM", "FAILURE_CATEGORY", "CLASSIFICATION_SOURCE")


def normalize(failures: DataFrame) -> DataFrame:
    """Upper-case names, plus the alias columns the other functions read, where they are absent."""
    df = failures.toDF(*[c.upper() for c in failures.columns])
    aliases = {
        "FAILURE_CATEGORY": ("CATEGORY", lambda c: c),
        "ERROR_MESSAGE": ("FAILURE_REASON", lambda c: c),
        "SEVERITY": ("PRIORITY", scalars.severity),
    }
    new = {
        name: build(F.col(source))
        for name, (source, build) in aliases.items()
        if source in df.columns and name not in df.columns
    }
    return df.withColumns(new) if new else df


def facet_filter(df: DataFrame, **chosen: list[str]) -> DataFrame:
    """Rows in every facet's selection; an empty selection or an absent column filters nothing."""
    for column, values in chosen.items():
        if values and column in df.columns:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def facet_values(df: DataFrame, facets: tuple[str, ...] = FACETS) -> DataFrame:
    """(facet, value) pairs to choose from, sorted, from one pass over the table."""
    present = [f for f in facets if f in df.columns]
    combinations = df.groupBy(*present).agg(F.lit(1).alias("_one"))
    pairs = ", ".join(f"'{f}', `{f}`" for f in present)
    listed = combinations.select(F.expr(f"stack({len(present)}, {pairs}) as (facet, value)"))
    return listed.filter(F.col("value").isNotNull()).distinct().orderBy("facet", "value")


def kpis(df: DataFrame) -> DataFrame:
    """One row: total, critical, classified by rule, classified by the fallback model."""

    def among(column: str, hit: Column) -> Column:
        return F.count_if(hit) if column in df.columns else F.lit(0).cast("bigint")

    source = F.col("CLASSIFICATION_SOURCE")
    return df.agg(
        F.count("*").alias("total_failures"),
        among("SEVERITY", F.upper("SEVERITY") == "CRITICAL").alias("critical_failures"),
        among("CLASSIFICATION_SOURCE", scalars.mentions(source, "RULE")).alias("rule_classified"),
        among("CLASSIFICATION_SOURCE", scalars.mentions(source, "LLM")).alias("model_classified"),
    )


def value_counts(df: DataFrame, column: str, alias: str, count: str) -> DataFrame:
    """Rows per value, most frequent first, names breaking ties. NULLs are dropped."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(alias)).agg(F.count("*").alias(count))
    return counts.orderBy(F.desc(count), alias)


def value_share(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Share of each value in the total of all non-NULL values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(alias)).agg(F.count("*").alias("failures"))
    total = counts.agg(F.sum("failures")).scalar()
    return counts.withColumn("share", F.round(F.col("failures") / total, 6))


def triage_queue(df: DataFrame, columns: tuple[str, ...] = QUEUE_COLUMNS) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def drilldown(df: DataFrame) -> DataFrame:
    """Fields of one incident; a default stands in for an absent column, not for a NULL."""
    fields = [F.col(n) if n in df.columns else F.lit(v).alias(n) for n, v in DRILLDOWN_DEFAULTS.items()]
    job = F.col("JOB_ID") if "JOB_ID" in df.columns else F.lit(None).cast("bigint").alias("JOB_ID")
    return df.select(job, *fields)


def lookback(df: DataFrame, as_of: str, days: int, column: str = "created_at") -> DataFrame:
    """Rows created on the inclusive dates ``[as_of - days, as_of]``, as a range Parquet can prune by."""
    end = F.lit(as_of).cast("date")
    start = F.date_sub(end, days).cast("timestamp_ntz")
    return df.filter((F.col(column) >= start) & (F.col(column) < F.date_add(end, 1).cast("timestamp_ntz")))


def recent_runs(runs: DataFrame, repository: list[str], max_pages: int = 5, per_page: int = 100) -> DataFrame:
    """The newest runs of each repository, at most ``max_pages`` pages of them."""
    order = [F.col("created_at").desc_nulls_last(), F.col("workflow_run_id").desc()]
    return top_per_group(runs, repository, order, max_pages * per_page, salts=32)


def source_profile(runs: DataFrame, repository: list[str]) -> DataFrame:
    """Runs of each repository by outcome."""
    return runs.groupBy(*repository).agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("conclusion") == "success").alias("successful_runs"),
        F.count_if(F.col("conclusion") == "failure").alias("failed_runs"),
        F.count_if(F.col("status").isin(*schemas.OPEN_STATUSES)).alias("open_runs"),
    )


def failed_jobs_per_run(jobs: DataFrame) -> DataFrame:
    """Jobs and failed jobs of each run."""
    return jobs.groupBy("workflow_run_id").agg(
        F.count("*").alias("jobs"), F.count_if(F.col("conclusion") == "failure").alias("failed_jobs")
    )
