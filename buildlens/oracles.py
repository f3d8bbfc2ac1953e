"""The queries again, as SQL over the sample tables, written without the library's code paths."""

from __future__ import annotations

from buildlens import samples, schemas
from buildlens.operators import classify, quality

_RUNS = """
runs AS (
  SELECT o_orderkey AS workflow_run_id, o_orderpriority AS workflow_name, c_mktsegment AS head_branch,
    CASE WHEN o_custkey % 50 <> 0 THEN 'sha' || o_custkey END AS head_sha,
    'evt_' || (c_nationkey % 4) AS event_type,
    CASE WHEN o_orderstatus = 'P' THEN 'in_progress' ELSE 'completed' END AS status,
    CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' END AS conclusion,
    c_name AS triggered_by, o_orderdate AS created_at,
    o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER)) AS updated_at, CAST(1 AS BIGINT) AS run_attempt
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

_LINES = """
lines AS (
  SELECT l.*, p_name, split_part(p_name, ' ', 2) AS word,
    CASE l_linestatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' END AS line_status,
    CASE WHEN l_returnflag = 'A' THEN 'success' WHEN l_returnflag = 'R' THEN 'failure'
      WHEN l_linestatus = 'F' THEN 'skipped' ELSE 'cancelled' END AS line_conclusion,
    l_shipdate + to_seconds(CAST(l_quantity AS BIGINT) * 1000) AS line_end
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) l
  JOIN part ON l_partkey = p_partkey
  WHERE rn = 1),
named AS (
  SELECT *, CASE word WHEN 'anvil' THEN 'pre-commit hooks' WHEN 'bolt' THEN 'Run Tests' WHEN 'gear' THEN 'smoke check'
    WHEN 'gizmo' THEN 'Pre-Commit Test' WHEN 'ring' THEN NULL ELSE p_name END AS step_name FROM lines)"""

_JOBS = """
jobs AS (
  SELECT l_orderkey AS workflow_run_id, l_orderkey * 10 + l_linenumber AS job_id, p_name AS job_name,
    'runner-' || l_suppkey AS runner_name, line_status AS status, line_conclusion AS conclusion,
    l_shipdate AS started_at, line_end AS completed_at
  FROM lines)"""

_S = """
s_runs AS (
  SELECT c_custkey AS workflow_run_id,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'Lint' WHEN 'BUILDING' THEN 'Test Suite' ELSE c_mktsegment END AS workflow_name,
    c_mktsegment AS head_branch, 'sha' || c_custkey AS head_sha, 'evt_' || (c_nationkey % 4) AS event_type,
    c_name AS triggered_by, 'completed' AS status
  FROM customer),
s_jobs AS (
  SELECT o_custkey AS workflow_run_id, o_orderkey AS job_id, o_orderpriority AS job_name,
    CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' END AS conclusion,
    'runner-' || (o_orderkey % 10) AS runner_name
  FROM orders),
s_steps AS (
  SELECT l_orderkey AS job_id, o_custkey AS workflow_run_id, CAST(l_linenumber AS BIGINT) AS step_number, step_name,
    CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'failure' ELSE line_status END AS status,
    CASE WHEN l_linenumber <> 7 THEN line_conclusion END AS conclusion,
    l_shipdate AS started_at, line_end AS completed_at, date_diff('second', l_shipdate, line_end) AS duration_seconds
  FROM named JOIN orders ON l_orderkey = o_orderkey)"""

_EXECUTIONS = """
executions AS (
  SELECT s.job_id, s.step_number, s.step_name, s.status AS step_status, s.conclusion AS step_conclusion,
    s.started_at AS step_started_at, s.completed_at AS step_completed_at,
    date_diff('second', s.started_at, s.completed_at) AS step_duration_seconds,
    coalesce(s.conclusion = 'success', false) AS is_successful_step,
    j.workflow_run_id, j.job_name, j.runner_name, j.conclusion AS job_conclusion,
    w.workflow_name, w.head_branch, w.head_sha, w.triggered_by, w.event_type
  FROM s_steps s JOIN s_jobs j ON s.job_id = j.job_id JOIN s_runs w ON j.workflow_run_id = w.workflow_run_id)"""

_LOGS = """
failed_logs AS (
  SELECT workflow_run_id, job_id, step_number, step_name, conclusion AS failure_reason, duration_seconds,
    started_at, completed_at
  FROM s_steps
  WHERE conclusion NOT IN ('success', 'skipped') OR (conclusion IS NULL AND status = 'failure'))"""

_BAD = "('failure', 'timed_out', 'cancelled')"
_EVENTS = f"""
events_f AS (
  SELECT * EXCLUDE (job_conclusion, step_duration_seconds, is_successful_step) FROM executions
  WHERE step_conclusion IN {_BAD} OR job_conclusion IN {_BAD})"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rules() -> str:
    arms = " ".join(
        "WHEN " + " OR ".join(f"{column} ILIKE '%{token}%'" for column, token in rule.needles) + f" THEN {number}"
        for number, rule in enumerate(schemas.NAME_RULES, 1)
    )
    rows = ", ".join(
        f"({number}, {_quoted(r.category)}, {_quoted(r.assigned_team)}, {_quoted(r.recommended_fix)})"
        for number, r in enumerate(schemas.NAME_RULES, 1)
    )
    return f"""
ruled AS (SELECT *, CASE {arms} END AS rule FROM events_f),
outputs(rule, category, assigned_team, recommended_fix) AS (VALUES {rows}),
failures AS (
  SELECT workflow_run_id, job_id, step_number, step_name, job_name, workflow_name, head_branch, head_sha, triggered_by,
    event_type, step_started_at, step_completed_at, coalesce(step_conclusion, 'failure') AS failure_reason,
    coalesce(category, 'UNCLASSIFIED_FALLBACK') AS category, coalesce(assigned_team, 'Platform Triage') AS assigned_team,
    coalesce(recommended_fix, 'Inspect execution logs for failure context.') AS recommended_fix,
    CASE WHEN step_name ILIKE '%pre-commit%' OR step_name ILIKE '%test%' OR step_name ILIKE '%smoke%'
      THEN 'DETERMINISTIC_RULE' ELSE 'UNCLASSIFIED_FALLBACK' END AS classification_source,
    CASE WHEN step_name ILIKE '%test%' THEN 1 ELSE 2 END AS priority
  FROM ruled LEFT JOIN outputs USING (rule))"""


_CONTEXT = """'Workflow: ' || coalesce(workflow_name, 'None') || ' | Step: ' || coalesce(step_name, 'None')
  || ' | Reason: ' || coalesce(failure_reason, 'None')"""


def _fallback() -> str:
    def pick(field: int) -> str:
        arms = " ".join(
            f"WHEN contains(lower({_CONTEXT}), {_quoted(a[0])}) THEN {_quoted(a[field])}" for a in classify.OFFLINE_ANSWERS
        )
        name = classify.RESULT_FIELDS[field - 1]
        other = _quoted(classify.OFFLINE_DEFAULT[field - 1])
        return f"CASE WHEN classification_source <> 'UNCLASSIFIED_FALLBACK' THEN {name} {arms} ELSE {other} END AS {name}"

    return f"""
answered AS (
  SELECT * EXCLUDE (category, assigned_team, recommended_fix, classification_source), {pick(1)}, {pick(2)}, {pick(3)},
    CASE WHEN classification_source = 'UNCLASSIFIED_FALLBACK' THEN 'LLM_FALLBACK' ELSE classification_source END
      AS classification_source
  FROM failures)"""


_NESTED = """
n_runs AS (
  SELECT o_orderkey AS run_id, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS run_name,
    CASE WHEN o_orderstatus = 'P' THEN 'in_progress' ELSE 'completed' END AS run_status,
    CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' END AS run_conclusion,
    o_orderdate AS run_started, o_orderdate + to_days(CAST(o_orderkey % 10 AS INTEGER)) AS run_updated,
    o_custkey, c_name, c_mktsegment, o_orderkey % 10 IN (1, 2, 3) AS listless
  FROM orders JOIN customer ON o_custkey = c_custkey),
n_lines AS (SELECT r.*, n.* FROM n_runs r JOIN named n ON r.run_id = n.l_orderkey WHERE NOT listless),
n_jobs AS (
  SELECT run_id AS workflow_run_id, l_orderkey * 10 + l_linenumber AS job_id,
    coalesce(CASE WHEN word <> 'ring' THEN p_name END, run_name, 'Default Job') AS job_name,
    coalesce(line_status, run_status) AS status,
    CASE WHEN line_conclusion <> 'cancelled' THEN line_conclusion ELSE run_conclusion END AS conclusion,
    l_shipdate AS started_at, CASE WHEN line_conclusion <> 'cancelled' THEN line_end ELSE run_updated END AS completed_at,
    CASE WHEN l_linenumber <> 6 THEN 'runner-' || l_suppkey ELSE 'GitHub Hosted Runner' END AS runner_name
  FROM n_lines),
n_alone AS (SELECT * FROM n_runs WHERE listless OR run_id NOT IN (SELECT l_orderkey FROM lines))"""

_MARK = "'sample' AS source_file_name, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_STAR = (_LINES, _S, _EXECUTIONS)
_FAILURES = (*_STAR, _EVENTS, _rules())

_FCT_RUNS = """
per_run AS (
  SELECT workflow_run_id, count(job_id) AS total_jobs, count(*) FILTER (conclusion = 'success') AS ok,
    count(*) FILTER (conclusion IN ('failure', 'timed_out', 'cancelled')) AS bad,
    min(started_at) AS first_job_started_at, max(completed_at) AS last_job_completed_at
  FROM jobs GROUP BY 1),
fct_runs AS (
  SELECT w.*, total_jobs, coalesce(ok, 0) AS successful_jobs, coalesce(bad, 0) AS failed_jobs, first_job_started_at,
    last_job_completed_at,
    date_diff('second', first_job_started_at, last_job_completed_at) AS total_execution_duration_seconds,
    coalesce(bad, 0) > 0 AS has_job_failure
  FROM runs w LEFT JOIN per_run USING (workflow_run_id))"""

_FINGERPRINT = "sha256(concat_ws(':', count(*), {}))".format(
    ", ".join(
        f"CAST(sum(CAST('0x' || substr(h, {1 + 15 * i}, 15) AS BIGINT) // {1 << shift} % {1 << 20}) AS BIGINT)"
        for i in range(3)
        for shift in (40, 20, 0)
    )
)


def _digest(columns: dict[str, str]) -> str:
    cells = ", ".join(f"coalesce(CAST({columns[c]} AS VARCHAR), '∅')" for c in sorted(columns))
    return f"sha256(concat_ws(chr(1), {cells}))"


_RECORD_DIGEST = _digest(
    {
        "id": "workflow_run_id",
        "name": "workflow_name",
        "head_branch": "head_branch",
        "head_sha": "head_sha",
        "event": "event_type",
        "status": "status",
        "conclusion": "conclusion",
        "run_attempt": "run_attempt",
        "actor": """'{"login":"' || triggered_by || '"}'""",
        "created_at": "replace(CAST(created_at AS VARCHAR), ' ', 'T') || 'Z'",
        "updated_at": "replace(CAST(updated_at AS VARCHAR), ' ', 'T') || 'Z'",
        "run_started_at": "replace(CAST(created_at AS VARCHAR), ' ', 'T') || 'Z'",
        "composite_key": "workflow_run_id || '_' || run_attempt",
        "repo_owner": "head_branch",
        "repo_name": "workflow_name",
    }
)
_LINE_DIGEST = _digest(
    {
        c: c
        for c in (
            "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
            "l_shipdate"
        ).split()
    }
)

_RUN_FIELDS = "workflow_run_id, workflow_name, head_branch, head_sha, event_type, status, conclusion, triggered_by, created_at, updated_at, run_attempt"
_LINE_FIELDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate"
_NEWEST = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC"


def _first_line(order: str) -> str:
    return f"""SELECT {_LINE_FIELDS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"""


# the lines in the order of three loads, A, N and R: rn counts from the last one, place from the first
_LOADED = f"""SELECT *,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_returnflag DESC, {_NEWEST}) AS rn,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_returnflag, {_NEWEST}) AS place FROM lineitem"""

_LATE = f"""WITH flagged AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag = 'R' ORDER BY {_NEWEST}) AS rn
  FROM lineitem),
known AS (SELECT * FROM flagged WHERE rn = 1 AND l_returnflag <> 'R'),
late AS (SELECT * FROM flagged WHERE rn = 1 AND l_returnflag = 'R')
SELECT k.l_orderkey, k.l_linenumber, k.l_partkey,
  CASE WHEN {{hit}} THEN l.l_linestatus ELSE k.l_linestatus END AS status,
  CASE WHEN {{hit}} THEN l.l_returnflag ELSE k.l_returnflag END AS conclusion,
  CASE WHEN {{hit}} THEN l.l_shipdate ELSE k.l_shipdate END AS updated_at
FROM known k LEFT JOIN late l ON k.l_orderkey = l.l_orderkey AND k.l_linenumber = l.l_linenumber"""

_WINDOW = "created_at >= DATE '2001-08-01' - INTERVAL 60 DAY AND created_at < DATE '2001-08-01' + INTERVAL 1 DAY"


def _log_rules() -> str:
    rows = ", ".join(
        f"({_quoted(p)}, {_quoted(c)}, {_quoted(t)}, {n}, {_quoted(f)})" for p, c, t, n, f in samples.SAMPLE_RULES
    )
    return f"rules(error_pattern, category, assigned_team, priority, recommended_fix) AS (VALUES {rows})"


def _suite() -> str:
    seeds = ", ".join(
        f"({_quoted(p)}, {_quoted(c)}, {_quoted(t)}, {n}, {_quoted(f)})" for p, c, t, n, f in schemas.LOG_RULES
    )
    source = {
        "stg_workflow_runs": "s_runs",
        "stg_jobs": "s_jobs",
        "stg_steps": "s_steps",
        "stg_failed_logs": "failed_logs",
        "int_failure_events": "events_f",
        "fct_workflow_runs": "s_runs",
        "fct_step_executions": "executions",
        "fct_actionable_failures": "failures",
        "dim_repositories": "(SELECT DISTINCT workflow_name, head_branch FROM s_runs)",
        "dim_commits": "(SELECT DISTINCT head_sha, head_branch, triggered_by FROM s_runs WHERE head_sha IS NOT NULL)",
        "dim_error_categories": "(SELECT DISTINCT failure_reason FROM failed_logs WHERE failure_reason IS NOT NULL)",
        "error_classification_rules": "seeds",
    }
    parts = []
    for check in quality.DECLARED:
        table, column = source[check.table], check.column
        if check.kind == "not_null":
            failing = f"SELECT 1 FROM {table} WHERE {column} IS NULL"
        elif check.kind == "unique":
            failing = f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        elif check.kind == "relationships":
            failing = f"""SELECT 1 FROM {table} c LEFT JOIN {source[check.parent_table]} p
              ON c.{column} = p.{check.parent_column} WHERE c.{column} IS NOT NULL AND p.{check.parent_column} IS NULL"""
        else:
            failing = """SELECT 1 FROM executions e JOIN failures f ON e.job_id = f.job_id AND e.step_number = f.step_number
              WHERE lower(e.step_status) = 'success' OR lower(e.step_conclusion) = 'success'"""
        parts.append(
            f"SELECT '{check.name}' AS check_name, '{check.kind}' AS check_kind, '{check.table}' AS table_name, "
            f"'{column}' AS column_name, (SELECT count(*) FROM ({failing})) AS failures"
        )
    head = _with(
        *_FAILURES, _LOGS, f"seeds(error_pattern, category, assigned_team, priority, recommended_fix) AS (VALUES {seeds})"
    )
    return (
        head
        + " SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


ORACLES: dict[str, str] = {
    "fct_workflow_runs": _with(_RUNS, _LINES, _JOBS, _FCT_RUNS) + " SELECT * FROM fct_runs",
    "fct_step_executions": _with(*_STAR) + " SELECT * EXCLUDE (job_conclusion) FROM executions",
    "stg_failed_logs": _with(_LINES, _S, _LOGS) + " SELECT * FROM failed_logs",
    "int_failure_events": _with(*_STAR, _EVENTS) + " SELECT * FROM events_f",
    "failed_steps_only": _with(*_STAR, _EVENTS) + f" SELECT * FROM events_f WHERE step_conclusion IN {_BAD}",
    "fct_actionable_failures": _with(*_FAILURES) + " SELECT * FROM failures",
    "dim_repositories": _with(_RUNS)
    + """ SELECT workflow_name, head_branch, count(DISTINCT workflow_run_id) AS total_runs, min(created_at) AS first_seen_at,
      max(created_at) AS last_seen_at FROM runs GROUP BY 1, 2""",
    "dim_commits": _with(_RUNS)
    + """ SELECT head_sha, head_branch, triggered_by, count(DISTINCT workflow_run_id) AS total_runs,
      min(created_at) AS first_commit_run_at, max(created_at) AS last_commit_run_at
      FROM runs WHERE head_sha IS NOT NULL GROUP BY 1, 2, 3""",
    "dim_error_categories": _with(_LINES, _S, _LOGS)
    + """ SELECT failure_reason, count(DISTINCT workflow_run_id) AS affected_workflow_runs,
      count(DISTINCT job_id) AS affected_jobs, count(*) AS total_occurrences
      FROM failed_logs WHERE failure_reason IS NOT NULL GROUP BY 1""",
    "pass_rate": _with(_RUNS)
    + """ SELECT workflow_name, count(*) AS completed_runs, count(*) FILTER (conclusion = 'success') AS passed_runs,
      round(count(*) FILTER (conclusion = 'success') / count(*), 6) AS pass_rate
      FROM runs WHERE status = 'completed' GROUP BY 1""",
    "step_duration_stats": _with(*_STAR)
    + """ SELECT workflow_name, count(*) AS steps, min(step_duration_seconds) AS min_seconds,
      max(step_duration_seconds) AS max_seconds, round(avg(step_duration_seconds), 6) AS avg_seconds,
      round(quantile_cont(CAST(step_duration_seconds AS DOUBLE), 0.5), 6) AS p50_seconds,
      round(quantile_cont(CAST(step_duration_seconds AS DOUBLE), 0.9), 6) AS p90_seconds,
      round(quantile_cont(CAST(step_duration_seconds AS DOUBLE), 0.99), 6) AS p99_seconds
      FROM executions GROUP BY 1""",
    "step_duration_histogram": _with(*_STAR)
    + """ SELECT workflow_name, step_duration_seconds // 10000 * 10000 AS from_seconds, count(*) AS steps
      FROM executions GROUP BY 1, 2""",
    "duration_seconds": """SELECT event_id, date_diff('second', ts,
      ts + to_microseconds(CAST(round(value * 1000) AS BIGINT) * 1000)) AS duration_seconds FROM events""",
    "stg_workflow_runs": _with(_LINES, _NESTED)
    + f""" SELECT run_id AS workflow_run_id, run_name AS workflow_name, c_mktsegment AS head_branch,
      'sha' || o_custkey AS head_sha, 'push' AS event_type, run_status AS status, run_conclusion AS conclusion,
      c_name AS triggered_by, run_started AS created_at, run_updated AS updated_at, CAST(1 AS BIGINT) AS run_attempt, {_MARK}
      FROM n_runs""",
    "stg_jobs": _with(_LINES, _NESTED)
    + f""" SELECT *, {_MARK} FROM n_jobs UNION ALL
      SELECT run_id, run_id, coalesce(run_name, 'Default Job'), run_status, run_conclusion, run_started, run_updated,
        'GitHub Hosted Runner', {_MARK} FROM n_alone""",
    "stg_jobs_strict": _with(_LINES, _NESTED)
    + f""" SELECT run_id AS workflow_run_id, l_orderkey * 10 + l_linenumber AS job_id,
        CASE WHEN word <> 'ring' THEN p_name END AS job_name, line_status AS status,
        CASE WHEN line_conclusion <> 'cancelled' THEN line_conclusion END AS conclusion, l_shipdate AS started_at,
        CASE WHEN line_conclusion <> 'cancelled' THEN line_end END AS completed_at,
        CASE WHEN l_linenumber <> 6 THEN 'runner-' || l_suppkey END AS runner_name, {_MARK}
      FROM n_lines""",
    "stg_steps": _with(_LINES, _NESTED)
    + """, found AS (
      SELECT l_orderkey * 10 + l_linenumber AS job_id, run_id AS workflow_run_id, CAST(1 AS BIGINT) AS step_number,
        step_name, line_status AS status, 'success' AS conclusion, l_shipdate AS started_at, line_end AS completed_at
      FROM n_lines WHERE l_linenumber IN (1, 2)
      UNION ALL
      SELECT l_orderkey * 10 + l_linenumber, run_id, 2, step_name, line_status, line_conclusion, l_shipdate, line_end
      FROM n_lines WHERE l_linenumber IN (1, 2)
      UNION ALL
      SELECT l_orderkey * 10 + l_linenumber, run_id, 1, step_name, line_status, NULL, l_shipdate, line_end
      FROM n_lines WHERE l_linenumber = 7
      UNION ALL
      SELECT l_orderkey * 10 + l_linenumber, run_id, 1, coalesce(run_name, 'Workflow Execution'), run_status,
        run_conclusion, run_started, run_updated FROM n_lines WHERE l_linenumber = 5
      UNION ALL
      SELECT run_id, run_id, 1, coalesce(run_name, 'Workflow Execution'), run_status, run_conclusion, run_started,
        run_updated FROM n_alone)
      SELECT *, date_diff('second', started_at, completed_at) AS duration_seconds FROM found""",
    "attach_jobs": _with(_RUNS, _LINES, _JOBS)
    + """ SELECT w.workflow_run_id, w.workflow_run_id || '_1' AS run_composite_key,
      coalesce(job_id, w.workflow_run_id) AS job_id, coalesce(job_name, workflow_name, 'Default Job') AS job_name,
      coalesce(j.status, w.status) AS status, coalesce(j.conclusion, w.conclusion) AS conclusion,
      coalesce(started_at, created_at) AS started_at, coalesce(completed_at, updated_at) AS completed_at,
      coalesce(runner_name, 'GitHub Hosted Runner') AS runner_name
      FROM runs w LEFT JOIN jobs j ON w.workflow_run_id = j.workflow_run_id""",
    "composite_keys": _with(_RUNS, _LINES, _JOBS)
    + """ SELECT job_id, j.workflow_run_id AS run_id, j.workflow_run_id || '_' || job_id || '_1' AS composite_job_key,
      j.workflow_run_id || '_1' AS run_composite_key, head_branch AS repo_owner, workflow_name AS repo_name
      FROM jobs j JOIN runs w ON j.workflow_run_id = w.workflow_run_id""",
    "latest_per_key": _first_line(_NEWEST),
    "merge_upsert": _first_line(f"l_returnflag = 'R' DESC, l_returnflag = 'N' DESC, {_NEWEST}"),
    "merge_idempotent": _first_line(f"l_returnflag = 'R' DESC, l_returnflag = 'N' DESC, {_NEWEST}"),
    "late_reconcile": _LATE.format(hit="l.l_orderkey IS NOT NULL"),
    "late_reconcile_newer": _LATE.format(hit="l.l_shipdate > k.l_shipdate"),
    "bronze_audit": """SELECT count(*) AS total_rows, count(DISTINCT l_orderkey || '_' || l_linenumber) AS distinct_keys
      FROM lineitem""",
    "unclassified_worklist": _with(*_FAILURES)
    + """ SELECT job_id, step_number, failure_reason, step_name, workflow_name FROM failures
      WHERE classification_source = 'UNCLASSIFIED_FALLBACK'""",
    "failure_context": _with(*_FAILURES)
    + f" SELECT job_id, step_number, {_CONTEXT} AS failure_context FROM failures",
    "classify_by_rule_table": f"""WITH {_log_rules()},
      ranked AS (SELECT doc_id, r.*, row_number() OVER (PARTITION BY doc_id ORDER BY priority, error_pattern) AS rn
        FROM documents LEFT JOIN rules r ON text ILIKE error_pattern)
      SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""",
    "classify_by_csv_rules": f"""WITH {_log_rules()},
      seed AS (SELECT * FROM rules UNION ALL SELECT '%, and%', 'Lists, "and" more', 'Docs "A", Team', 2, 'Say "and", once'),
      ranked AS (SELECT doc_id, r.*, row_number() OVER (PARTITION BY doc_id ORDER BY priority, error_pattern) AS rn
        FROM documents LEFT JOIN seed r ON text ILIKE error_pattern)
      SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""",
    "classify_by_long_rule_table": """WITH syllables AS (
        SELECT row_number() OVER () - 1 AS i, s FROM (SELECT unnest(
          ['th','en','er','on','an','re','in','ti','es','or','st','ed','to','it','is','ha']) AS s)),
      long AS (
        SELECT a.i * 16 + b.i AS n, '% ' || a.s || b.s || '%' AS error_pattern, 'Category ' || (a.i % 7) AS category,
          'Team ' || b.s AS assigned_team, CAST((a.i * 7 + b.i) % 40 AS INTEGER) AS priority, 'Fix ' || a.s AS recommended_fix
        FROM syllables a, syllables b),
      rules AS (
        SELECT * EXCLUDE (n) FROM long
        UNION ALL SELECT error_pattern, 'Again', 'Team', CAST(priority + 1 AS INTEGER), 'Fix' FROM long WHERE n < 50),
      logs AS (
        SELECT doc_id, text, CASE WHEN doc_id % 5 <> 0 THEN CAST(floor(doc_id / 3) AS BIGINT) END AS log_key FROM documents),
      ranked AS (
        SELECT doc_id, log_key, r.*, row_number() OVER (PARTITION BY doc_id ORDER BY priority, error_pattern) AS rn
        FROM logs LEFT JOIN rules r ON text ILIKE error_pattern)
      SELECT * EXCLUDE (rn, doc_id) FROM ranked WHERE rn = 1""",
    "classify_by_passage_rules": r"""WITH words AS (
        SELECT item_id, regexp_replace(substr(text, 1, 30), '([\\%_])', '\\\1', 'g') AS a,
          regexp_replace(substr(text, 41, 30), '([\\%_])', '\\\1', 'g') AS b FROM benchmark),
      rules AS (
        SELECT '%' || a || '%' || b || '%' AS error_pattern, 'Passage ' || item_id AS category,
          CASE WHEN item_id % 3 <> 0 THEN 'Team' END AS assigned_team, CAST(item_id % 7 AS INTEGER) AS priority,
          'Leave it out' AS recommended_fix
        FROM words),
      ranked AS (
        SELECT doc_id, r.*, row_number() OVER (PARTITION BY doc_id ORDER BY priority, error_pattern, category) AS rn
        FROM documents LEFT JOIN rules r ON text ILIKE error_pattern ESCAPE '\')
      SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""",
    "fallback_classify": _with(*_FAILURES, _fallback())
    + """ SELECT job_id, step_number, category, assigned_team, recommended_fix, classification_source FROM answered""",
    "triage_remembered": _with(*_FAILURES, _fallback())
    + """ SELECT job_id, step_number, category, assigned_team, recommended_fix, classification_source FROM answered""",
    "apply_classifications": _with(*_FAILURES)
    + """, marked AS (
        SELECT *, failure_reason = 'failure' AND classification_source = 'UNCLASSIFIED_FALLBACK' AS hit FROM failures)
      SELECT * EXCLUDE (hit, category, assigned_team, recommended_fix, classification_source),
        CASE WHEN hit THEN 'Category ' || event_type ELSE category END AS category,
        CASE WHEN hit THEN 'Team ' || head_branch ELSE assigned_team END AS assigned_team,
        CASE WHEN hit THEN 'Ask ' || triggered_by ELSE recommended_fix END AS recommended_fix,
        CASE WHEN hit THEN 'LLM_FALLBACK' ELSE classification_source END AS classification_source
      FROM marked""",
    "classification_coverage": _with(*_FAILURES)
    + """ SELECT classification_source, count(*) AS failures, round(count(*) / (SELECT count(*) FROM failures), 6) AS share
      FROM failures GROUP BY 1""",
    "append_partial": _with(*_FAILURES, _RUNS)
    + """ SELECT * FROM failures UNION ALL BY NAME
      SELECT workflow_run_id, workflow_run_id AS job_id, CAST(1 AS BIGINT) AS step_number, workflow_name,
        'stuck' AS failure_reason, 99 AS priority, 'unclassified' AS category,
        'UNCLASSIFIED_FALLBACK' AS classification_source
      FROM runs WHERE status = 'in_progress'""",
    "severity": _with(*_FAILURES)
    + """ SELECT job_id AS "JOB_ID", step_number AS "STEP_NUMBER", priority AS "PRIORITY",
      CASE WHEN priority IN (1, 99) THEN 'CRITICAL' ELSE 'MEDIUM' END AS "SEVERITY" FROM failures""",
    "triage_queue": _with(*_FAILURES)
    + """ SELECT job_id AS "JOB_ID", job_name AS "JOB_NAME", workflow_name AS "WORKFLOW_NAME",
      category AS "FAILURE_CATEGORY", CASE WHEN priority IN (1, 99) THEN 'CRITICAL' ELSE 'MEDIUM' END AS "SEVERITY",
      assigned_team AS "ASSIGNED_TEAM", classification_source AS "CLASSIFICATION_SOURCE",
      recommended_fix AS "RECOMMENDED_FIX" FROM failures""",
    "failure_drilldown": _with(*_FAILURES)
    + """ SELECT job_id AS "JOB_ID", job_name AS "JOB_NAME", category AS "FAILURE_CATEGORY",
      assigned_team AS "ASSIGNED_TEAM", classification_source AS "CLASSIFICATION_SOURCE",
      'Inspect logs' AS "RECOMMENDED_FIX", failure_reason AS "ERROR_MESSAGE" FROM failures""",
    "facet_filter": _with(*_FAILURES)
    + """ SELECT job_id AS "JOB_ID", step_number AS "STEP_NUMBER", assigned_team AS "ASSIGNED_TEAM",
      classification_source AS "CLASSIFICATION_SOURCE" FROM failures
      WHERE assigned_team IN ('Backend Engineering', 'Core Maintainers') AND classification_source = 'DETERMINISTIC_RULE'""",
    "facet_values": _with(*_FAILURES)
    + """ SELECT DISTINCT 'ASSIGNED_TEAM' AS facet, assigned_team AS value FROM failures UNION ALL
      SELECT DISTINCT 'FAILURE_CATEGORY', category FROM failures UNION ALL
      SELECT DISTINCT 'CLASSIFICATION_SOURCE', classification_source FROM failures""",
    "failure_kpis": _with(*_FAILURES, _fallback())
    + """ SELECT count(*) AS total_failures, count(*) FILTER (priority IN (1, 99)) AS critical_failures,
      count(*) FILTER (classification_source ILIKE '%rule%') AS rule_classified,
      count(*) FILTER (classification_source ILIKE '%llm%') AS model_classified FROM answered""",
    "counts_by_category": _with(*_FAILURES) + " SELECT category, count(*) AS failures FROM failures GROUP BY 1",
    "counts_by_team": _with(*_FAILURES)
    + " SELECT assigned_team AS team, count(*) AS incidents FROM failures GROUP BY 1",
    "ranked_teams": _with(*_FAILURES)
    + """ SELECT team, incidents, CAST(row_number() OVER (ORDER BY incidents DESC, team) AS INTEGER) AS place
      FROM (SELECT assigned_team AS team, count(*) AS incidents FROM failures GROUP BY 1)""",
    "category_share": _with(*_FAILURES)
    + """ SELECT category, count(*) AS failures, round(count(*) / (SELECT count(*) FROM failures), 6) AS share
      FROM failures GROUP BY 1""",
    "lookback_window": _with(_RUNS)
    + f" SELECT workflow_run_id, created_at, head_branch, workflow_name FROM runs WHERE {_WINDOW}",
    "recent_runs": _with(_RUNS)
    + """ SELECT * EXCLUDE (rn) FROM (SELECT head_branch, workflow_name, workflow_run_id, created_at, row_number() OVER (
      PARTITION BY head_branch, workflow_name ORDER BY created_at DESC, workflow_run_id DESC) AS rn FROM runs)
      WHERE rn <= 500""",
    "source_profile": _with(_RUNS)
    + f""" SELECT head_branch, workflow_name, count(*) AS total_runs,
      count(*) FILTER (conclusion = 'success') AS successful_runs, count(*) FILTER (conclusion = 'failure') AS failed_runs,
      count(*) FILTER (status IN ('in_progress', 'queued')) AS open_runs FROM runs WHERE {_WINDOW} GROUP BY 1, 2""",
    "failed_jobs_per_run": _with(_LINES, _JOBS)
    + """ SELECT workflow_run_id, count(*) AS jobs, count(*) FILTER (conclusion = 'failure') AS failed_jobs
      FROM jobs GROUP BY 1""",
    "land_manifest": _with(_RUNS)
    + f""" SELECT head_branch AS repo_owner, workflow_name AS repo_name, 'workflow_runs' AS entity,
      '/repos/' || head_branch || '/' || workflow_name || '/actions/runs' AS source_endpoint,
      count(*) AS record_count, {_FINGERPRINT} AS payload_hash
      FROM (SELECT *, {_RECORD_DIGEST} AS h FROM runs) GROUP BY head_branch, workflow_name""",
    "payload_fingerprint": f"""SELECT l_returnflag, l_linestatus, {_FINGERPRINT} AS payload_hash
      FROM (SELECT *, {_LINE_DIGEST} AS h FROM lineitem) GROUP BY 1, 2""",
    "land_by_status": _with(_RUNS)
    + """ SELECT s.status, count(workflow_run_id) > 0 AS landed, count(workflow_run_id) AS records
      FROM (VALUES ('completed'), ('in_progress'), ('lost')) s(status) LEFT JOIN runs ON runs.status = s.status
      GROUP BY s.status""",
    "lake_roundtrip": _with(_RUNS)
    + f""" SELECT {_RUN_FIELDS}, head_branch AS lake_owner, workflow_name AS lake_repo, 'workflow_runs' AS lake_entity,
      DATE '2024-01-01' AS lake_date FROM runs""",
    "dq_envelope_counts": """SELECT count(*) AS record_count, count(*) AS data_count, CAST(0 AS BIGINT) AS mismatches,
      true AS bounded FROM orders JOIN customer ON o_custkey = c_custkey""",
    "load_quarantine": """SELECT CASE o_orderkey % 50 WHEN 0 THEN 'line' WHEN 1 THEN 'key' WHEN 2 THEN 'value' WHEN 3 THEN 'key'
        ELSE 'merged' END AS outcome, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "load_unreadable_file": """SELECT 'merged' AS outcome, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderkey % 3 <> 2 UNION ALL SELECT 'file', 1""",
    "load_since": """SELECT o_orderkey AS run_id, CAST(1 AS BIGINT) AS run_attempt FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderkey % 3 IN (1, 2)""",
    "bronze_upsert": """SELECT DISTINCT l_orderkey, l_linenumber, lpad(CAST(l_orderkey % 12 AS VARCHAR), 2, '0') AS bucket,
      CASE WHEN l_linenumber <= 2 THEN 'second' ELSE 'first' END AS state FROM lineitem""",
    "bronze_delta": f"""SELECT lines.* EXCLUDE (rn, place), lpad(CAST(l_orderkey % 12 AS VARCHAR), 2, '0') AS bucket, stage
      FROM ({_LOADED}) AS lines, (VALUES ('loaded'), ('compacted')) AS stages(stage) WHERE rn = 1""",
    # a line stays in the month that the first load with it gave it
    "upsert_by_filter": f"""SELECT lines.* EXCLUDE (rn, place), first.month FROM ({_LOADED}) AS lines
      JOIN (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS month FROM ({_LOADED}) WHERE place = 1) AS first
      USING (l_orderkey, l_linenumber) WHERE rn = 1""",
    "refresh_incremental": _with(_LINES, _NESTED)
    + """, runs AS (
      SELECT run_id AS workflow_run_id, run_name AS workflow_name, c_mktsegment AS head_branch, 'sha' || o_custkey AS head_sha,
        'push' AS event_type, run_status AS status, run_conclusion AS conclusion, c_name AS triggered_by,
        CAST(1 AS BIGINT) AS run_attempt, run_started AS created_at, run_updated AS updated_at FROM n_runs),
      jobs AS (
      SELECT workflow_run_id, job_id, conclusion, started_at, completed_at FROM n_jobs
      UNION ALL SELECT run_id, run_id, run_conclusion, run_started, run_updated FROM n_alone),"""
    + _FCT_RUNS
    + " SELECT * FROM fct_runs",
    "quarantine_jobs": _with(_LINES, _NESTED)
    + """, steps AS (
      SELECT run_id, CASE WHEN run_id % 50 = 0 THEN NULL WHEN run_id % 50 = 4 AND number = 1 THEN 'rejected' ELSE 'read' END AS outcome
      FROM n_lines JOIN (VALUES (1, 1), (1, 2), (2, 1), (2, 2), (7, 1)) AS listed(line, number) ON l_linenumber = line
      UNION ALL SELECT run_id, 'read' FROM n_lines WHERE l_linenumber = 5 AND run_id % 50 <> 0
      UNION ALL SELECT run_id, 'read' FROM n_alone)
      SELECT 'job' AS level, CASE WHEN workflow_run_id % 50 = 0 THEN 'rejected' ELSE 'read' END AS outcome, count(*) AS n
      FROM (SELECT workflow_run_id FROM n_jobs UNION ALL SELECT 1 FROM n_alone) GROUP BY 2
      UNION ALL SELECT 'step', outcome, count(*) FROM steps WHERE outcome IS NOT NULL GROUP BY 2""",
    "latest_attempts": _with(_RUNS)
    + """ SELECT workflow_run_id, workflow_run_id % 3 + 1 AS run_attempt, status,
      workflow_run_id || '_' || (workflow_run_id % 3 + 1) AS composite_key FROM runs""",
    "build_from_jobs_entity": _with(_RUNS, _LINES, _JOBS)
    + """ SELECT w.workflow_run_id, coalesce(job_id, w.workflow_run_id) AS job_id,
      coalesce(job_name, workflow_name, 'Default Job') AS job_name, coalesce(j.status, w.status) AS status,
      coalesce(j.conclusion, w.conclusion) AS conclusion, coalesce(started_at, created_at) AS started_at,
      coalesce(completed_at, updated_at) AS completed_at, coalesce(runner_name, 'GitHub Hosted Runner') AS runner_name,
      CASE WHEN job_id IS NULL THEN 'run' ELSE 'job' END AS lineage
      FROM runs w LEFT JOIN jobs j ON w.workflow_run_id = j.workflow_run_id""",
    "stream_ingest": _with(_RUNS) + f" SELECT {_RUN_FIELDS} FROM runs",
    "stream_status": _first_line(_NEWEST),
    "stream_state": f"""SELECT *, l_linestatus = 'O' AND l_shipdate + INTERVAL 30 DAY <= (SELECT max(l_shipdate) FROM lineitem) AS stuck
      FROM ({_first_line(_NEWEST)})""",
    "quarantine_split": """SELECT event_id,
      CASE WHEN event_id % 50 <> 0 THEN CAST(props->>'$.k' AS BIGINT) END AS k,
      CASE WHEN event_id % 50 = 0 THEN substr(props, 1, length(props) - 1) END AS rejected_line FROM events""",
    "dq_not_null": _with(_RUNS, _LINES, _S)
    + " UNION ALL ".join(
        f" SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures FROM {v}"
        for t, v, columns in (
            ("runs", "runs", ("workflow_run_id", "status", "head_sha", "conclusion")),
            ("steps", "s_steps", ("job_id", "step_number", "step_name", "conclusion")),
        )
        for c in columns
    ),
    "dq_unique": _with(_RUNS)
    + """ SELECT 'lineitem' AS table_name, l_orderkey || '_' || l_linenumber AS key, count(*) AS n FROM lineitem
      GROUP BY 2 HAVING count(*) > 1 UNION ALL
      SELECT 'runs', CAST(workflow_run_id AS VARCHAR), count(*) FROM runs GROUP BY 2 HAVING count(*) > 1""",
    "dq_relationships": _with(_RUNS, _LINES, _JOBS)
    + """ SELECT 'runs' AS child, workflow_run_id, count(*) AS n FROM runs
      WHERE workflow_run_id NOT IN (SELECT workflow_run_id FROM jobs) GROUP BY 2 UNION ALL
      SELECT 'jobs', workflow_run_id, count(*) FROM jobs
      WHERE workflow_run_id NOT IN (SELECT workflow_run_id FROM runs) GROUP BY 2""",
    "dq_no_success_classified": _with(*_FAILURES)
    + """ SELECT e.job_id, e.step_number, e.step_name, e.step_status, e.step_conclusion, e.step_started_at,
      e.step_completed_at, f.workflow_run_id, f.failure_reason, f.category, f.assigned_team, f.recommended_fix
      FROM executions e JOIN failures f ON e.job_id = f.job_id AND e.step_number = f.step_number
      WHERE lower(e.step_status) = 'success' OR lower(e.step_conclusion) = 'success'""",
    "dq_suite": _suite(),
    "dq_rule_lengths": """SELECT 'error_pattern' AS column_name, count(*) FILTER (length(repeat(p_name, 15)) > 255) AS failures FROM part
      UNION ALL SELECT 'category', count(*) FILTER (length(repeat(p_name, 6)) > 100) FROM part
      UNION ALL SELECT 'assigned_team', count(*) FILTER (length(p_name) > 100) FROM part
      UNION ALL SELECT 'recommended_fix', count(*) FILTER (length(repeat(p_name, 30)) > 500) FROM part""",
}

ORACLES["dim_commits_by_days"] = ORACLES["dim_commits"]
ORACLES["dim_error_categories_by_days"] = ORACLES["dim_error_categories"]
