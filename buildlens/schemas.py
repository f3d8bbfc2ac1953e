"""Fixed values, table schemas and the default rule pack."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# Result states, tags and literals that must equal the ones the data already carries.
FAILED_CONCLUSIONS = ("failure", "timed_out", "cancelled")
HARMLESS_CONCLUSIONS = ("success", "skipped")
OPEN_STATUSES = ("in_progress", "queued")
CRITICAL_PRIORITIES = (1, 99)
DEFAULT_JOB_NAME = "Default Job"
DEFAULT_RUNNER = "GitHub Hosted Runner"
DEFAULT_STEP_NAME = "Workflow Execution"
TAG_RULE = "DETERMINISTIC_RULE"
TAG_FALLBACK = "LLM_FALLBACK"
TAG_UNCLASSIFIED = "UNCLASSIFIED_FALLBACK"
UNMATCHED_TEAM = "Platform Triage"
UNMATCHED_FIX = "Inspect execution logs for failure context."


class NameRule(NamedTuple):
    """One ordered rule: it fires when any named column contains its token, ignoring case."""

    needles: tuple[tuple[str, str], ...]
    category: str
    assigned_team: str
    recommended_fix: str


# The default rules, in matching order.
NAME_RULES = (
    NameRule(
        (("step_name", "pre-commit"), ("workflow_name", "lint"), ("job_name", "pre-commit")),
        "Linting & Style Checks",
        "Core Maintainers",
        "Run `pre-commit run --all-files` locally to auto-fix code formatting and linting hook failures.",
    ),
    NameRule(
        (("step_name", "test"), ("workflow_name", "test"), ("job_name", "test")),
        "Unit Test Failure",
        "Backend Engineering",
        "Inspect test execution logs for assertion failures, reproduce locally with pytest, and patch regression.",
    ),
    NameRule(
        (("step_name", "smoke"), ("workflow_name", "smoke"), ("job_name", "smoke")),
        "Smokeshow / Preview Build Failure",
        "Frontend / QA",
        "Verify SMOKESHOW credentials in repository secrets and validate build artifact output directory.",
    ),
)
# Tokens that earn the rule tag, and the one that earns priority 1; step name only.
STEP_TAG_TOKENS = ("pre-commit", "test", "smoke")
STEP_URGENT_TOKEN = "test"

RULE_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("error_pattern", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("assigned_team", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("recommended_fix", T.StringType()),
    ]
)
# Declared length limits of the rule table's text columns.
RULE_TABLE_LENGTHS = {"error_pattern": 255, "category": 100, "assigned_team": 100, "recommended_fix": 500}

# The default log-pattern rules, same columns as RULE_TABLE_SCHEMA.
LOG_RULES = (
    ("%ModuleNotFoundError%", "Missing Dependency", "Backend Team", 1,
     "Add the missing package to pyproject.toml or requirements.txt"),
    ("%ImportError%", "Missing Dependency", "Backend Team", 1,
     "Check module imports or circular dependencies in Python source"),
    ("%AssertionError%", "Test Failure", "QA / Feature Team", 2,
     "Inspect failed pytest assertions and mock fixtures"),
    ("%OperationalError%", "Database Infrastructure", "Platform / DevOps", 1,
     "Check database connection string also migrations or local postgres service"),
    ("%ConnectionRefusedError%", "Network Infrastructure", "Platform / DevOps", 1,
     "Ensure required service or container is running and listening on correct port"),
    ("%mypy%found%error%", "Type Check Failure", "Backend Team", 3,
     "Fix static type annotations flagged by mypy"),
    ("%ruff%failed%", "Lint / Style Violation", "Engineering Core", 3,
     "Run ruff format or ruff check --fix locally before pushing"),
    ("%flake8%failed%", "Lint / Style Violation", "Engineering Core", 3,
     "Fix code formatting and style issues reported by flake8"),
    ("%timed out%", "Execution Timeout", "Platform / DevOps", 2,
     "Increase step timeout limit or optimize slow-running tests"),
    ("%command not found%", "Runner Environment", "Platform / DevOps", 1,
     "Ensure tool or CLI binary is installed on the CI runner"),
)

CLASSIFICATION_SCHEMA = T.StructType(
    [
        T.StructField("failure_context", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("assigned_team", T.StringType()),
        T.StructField("recommended_fix", T.StringType()),
    ]
)

ACTIONABLE_SCHEMA = T.StructType(
    [
        T.StructField("workflow_run_id", T.LongType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("step_number", T.LongType()),
        T.StructField("step_name", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("workflow_name", T.StringType()),
        T.StructField("head_branch", T.StringType()),
        T.StructField("head_sha", T.StringType()),
        T.StructField("triggered_by", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("step_started_at", T.TimestampNTZType()),
        T.StructField("step_completed_at", T.TimestampNTZType()),
        T.StructField("failure_reason", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("assigned_team", T.StringType()),
        T.StructField("recommended_fix", T.StringType()),
        T.StructField("classification_source", T.StringType()),
        T.StructField("priority", T.IntegerType()),
    ]
)

BRONZE_KEYS = ["run_id", "run_attempt"]
