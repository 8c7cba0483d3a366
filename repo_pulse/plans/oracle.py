"""DuckDB oracle: the same results stated in plain SQL on the test tables.

The oracle never parses JSON and never uses the Spark adapters: it states
each typed staging column directly as a function of the source columns and
then follows the reference model definitions (dedup by row_number, direct
calendar x issues backlog join, and so on). Hygiene: integer results are
cast to BIGINT (DuckDB sums give HUGEINT), hours use ``date_sub`` (whole
elapsed hours, as the warehouse counts), NULL-strict ``greatest`` is a CASE.
"""

from __future__ import annotations

AS_OF = "DATE '2024-03-01'"
STALE_DAYS = 30

# ---------------------------------------------------------------- typed sources

PULL_VERSIONS = """
pv0 AS (
  SELECT concat('org/', n.n_name) AS repo_full_name, o.o_orderkey AS k, o.o_orderstatus AS st,
         o.o_orderdate AS created_at, o.o_orderpriority AS prio, o.o_custkey, c.c_name,
         o.o_totalprice, vv.v
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN (VALUES (0), (1)) vv(v) ON vv.v = 0 OR o.o_orderkey % 3 = 0
  {pull_filter}
),
pv1 AS (
  SELECT *, CASE st WHEN 'F' THEN created_at + to_hours(CAST(k * 7 % 500 AS BIGINT))
                    WHEN 'P' THEN created_at + to_hours(CAST(k * 11 % 900 AS BIGINT)) END AS closed_at
  FROM pv0
),
pull_versions AS (
  SELECT repo_full_name, v, k AS pr_number, k + 1000000 AS pull_request_id,
         concat('PR_', k) AS pull_request_node_id,
         CASE WHEN st = 'O' THEN 'open' ELSE 'closed' END AS pull_request_state,
         prio AS pull_request_title, prio = '5-LOW' AS is_draft,
         concat('https://x/', repo_full_name, '/pull/', k) AS pull_request_url,
         'main' AS base_branch, concat('b', k) AS head_branch,
         c_name AS author_login, o_custkey AS author_id,
         CAST(floor(o_totalprice) AS BIGINT) AS additions_count,
         k % 97 AS deletions_count, k % 13 AS changed_files_count, k % 11 AS comments_count,
         k % 7 AS review_comments_count, k % 19 AS commits_count,
         created_at,
         coalesce(closed_at, created_at + to_days(CAST(k % 45 AS INTEGER))) + to_days(v) AS updated_at,
         closed_at,
         CASE WHEN st = 'F' THEN closed_at END AS merged_at
  FROM pv1
),
pulls_typed AS (
  SELECT CAST(updated_at AS DATE) AS ingestion_date, * EXCLUDE (v) FROM pull_versions
),
stg_pulls AS (
  SELECT * FROM pulls_typed
  QUALIFY row_number() OVER (PARTITION BY repo_full_name, pr_number
                             ORDER BY updated_at DESC NULLS LAST, ingestion_date DESC NULLS LAST) = 1
)"""

REVIEW_VERSIONS = """
rv0 AS (
  SELECT concat('org/', n.n_name) AS repo_full_name, l.*,
         l.l_shipdate + to_minutes(CAST(l.l_partkey % 1440 AS BIGINT)) AS t,
         (l.l_linenumber = 5 AND l.l_quantity < 3) AS pending
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
reviews_typed AS (
  SELECT CAST(l_shipdate AS DATE) AS ingestion_date, repo_full_name,
         l_orderkey AS pr_number,
         l_orderkey * 10 + l_linenumber AS review_id,
         concat('R_', l_orderkey * 10 + l_linenumber) AS review_node_id,
         CASE WHEN pending THEN 'PENDING'
              WHEN l_returnflag = 'A' THEN 'APPROVED'
              WHEN l_returnflag = 'R' THEN 'CHANGES_REQUESTED'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'COMMENTED'
              ELSE 'DISMISSED' END AS review_state,
         concat('qty ', CAST(l_quantity AS BIGINT)) AS review_body,
         concat('https://x/pulls/', l_orderkey, '#r', l_orderkey * 10 + l_linenumber) AS review_url,
         concat('Supplier#', l_suppkey) AS reviewer_login,
         l_suppkey AS reviewer_id,
         CASE WHEN NOT pending AND l_linenumber <> 6 THEN t END AS submitted_at,
         CAST(NULL AS TIMESTAMP) AS created_at,
         CASE WHEN NOT pending THEN t END AS updated_at
  FROM rv0
),
stg_reviews AS (
  SELECT * FROM reviews_typed
  QUALIFY row_number() OVER (PARTITION BY repo_full_name, review_id
                             ORDER BY updated_at DESC NULLS LAST, ingestion_date DESC NULLS LAST) = 1
)"""

ISSUE_VERSIONS = """
ev0 AS (
  SELECT e.*, e.event_id // 2 AS number,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         CASE WHEN e.event_type IN ('purchase', 'signup')
              THEN e.ts + to_hours(CAST(floor(e.value) AS BIGINT)) END AS closed_at
  FROM events e
),
issues_typed AS (
  SELECT CAST(ts AS DATE) AS ingestion_date,
         concat('org/NATION_', number % 25) AS repo_full_name,
         number AS issue_number, number + 7000000 AS issue_id,
         concat('I_', number) AS issue_node_id,
         CASE WHEN closed_at IS NOT NULL THEN 'closed' ELSE 'open' END AS issue_state,
         CASE WHEN event_id % 9 = 0 THEN concat('[', event_type, '] ', user_id)
              ELSE concat(event_type, ' #', number) END AS issue_title,
         concat('https://x/issues/', number) AS issue_url,
         concat('u', user_id) AS author_login, user_id AS author_id,
         user_id % 9 AS comments_count,
         CAST(CASE WHEN event_id % 20 = 0 THEN 0 WHEN k % 10 = 0 THEN 3 ELSE 2 END AS BIGINT) AS labels_count,
         CASE WHEN event_id % 20 = 0 THEN '' ELSE concat(event_type, ',k', k) END AS labels_csv,
         CAST(date_trunc('day', ts) AS TIMESTAMP) - to_days(CAST(number % 40 AS INTEGER)) AS created_at,
         ts AS updated_at,
         closed_at,
         event_type AS src_event_type, event_id AS src_event_id
  FROM ev0
),
stg_issues AS (
  SELECT * EXCLUDE (src_event_type, src_event_id) FROM issues_typed
  WHERE NOT (src_event_type = 'error' OR (src_event_type = 'view' AND src_event_id % 50 = 0))
  QUALIFY row_number() OVER (PARTITION BY repo_full_name, issue_number
                             ORDER BY updated_at DESC NULLS LAST, ingestion_date DESC NULLS LAST) = 1
)"""

REVIEWS_AGG = """
int_pr_reviews_agg AS (
  SELECT repo_full_name, pr_number,
         min(submitted_at) AS first_review_at,
         CAST(count(*) AS BIGINT) AS review_count,
         CAST(count_if(review_state = 'APPROVED') AS BIGINT) AS approvals_count,
         CAST(count_if(review_state = 'CHANGES_REQUESTED') AS BIGINT) AS changes_requested_count,
         CAST(count_if(review_state = 'COMMENTED') AS BIGINT) AS commented_count,
         CAST(count(DISTINCT reviewer_login) AS BIGINT) AS unique_reviewer_count,
         max(updated_at) AS updated_at
  FROM stg_reviews
  WHERE pr_number IS NOT NULL
  GROUP BY 1, 2
)"""

PR_LIFECYCLE = """
int_pr_lifecycle AS (
  WITH reviewed AS (
    SELECT repo_full_name, pr_number, first_review_at, updated_at AS last_review_update, review_count, approvals_count,
           changes_requested_count, commented_count, unique_reviewer_count
    FROM int_pr_reviews_agg),
  paired AS (SELECT * FROM stg_pulls LEFT JOIN reviewed USING (repo_full_name, pr_number))
  SELECT * EXCLUDE (ingestion_date, pull_request_node_id, pull_request_url, base_branch, head_branch, last_review_update)
           REPLACE (ifnull(review_count, 0) AS review_count, ifnull(approvals_count, 0) AS approvals_count,
                    ifnull(changes_requested_count, 0) AS changes_requested_count, ifnull(commented_count, 0) AS commented_count,
                    ifnull(unique_reviewer_count, 0) AS unique_reviewer_count,
                    if(updated_at IS NULL, NULL, greatest(updated_at, last_review_update)) AS updated_at),
         updated_at AS pr_updated_at,
         (merged_at IS NOT NULL) AS is_merged,
         date_sub('hour', created_at, first_review_at) AS time_to_first_review_hours,
         date_sub('hour', created_at, merged_at) AS time_to_merge_hours,
         date_sub('hour', created_at, if(merged_at IS NULL, closed_at, NULL)) AS time_open_hours
  FROM paired
)"""

ISSUE_LIFECYCLE = """
int_issue_lifecycle AS (
  SELECT * EXCLUDE (ingestion_date),
         date_sub('hour', created_at, closed_at) AS time_to_close_hours,
         CAST(date_diff('day', CAST(created_at AS DATE), ifnull(CAST(closed_at AS DATE), {as_of})) AS BIGINT) AS issue_age_days,
         ifnull(issue_state = 'open' AND date_diff('day', CAST(updated_at AS DATE), {as_of}) > {stale}, FALSE) AS is_stale
  FROM stg_issues
)"""

FACT_PR = """
fact_pr_cycle_time AS (
  SELECT repo_full_name, pr_number, pull_request_id, pull_request_state, pull_request_title,
         author_login, author_id, is_draft, additions_count, deletions_count, changed_files_count,
         comments_count, review_comments_count, commits_count, created_at,
         CAST(created_at AS DATE) AS created_date, updated_at, closed_at, merged_at, first_review_at,
         review_count, approvals_count, changes_requested_count, commented_count, unique_reviewer_count,
         time_to_first_review_hours, time_to_merge_hours, time_open_hours, is_merged
  FROM int_pr_lifecycle
)"""

FACT_ISSUE = """
fact_issue_aging AS (
  SELECT repo_full_name, issue_number, issue_id, issue_node_id, issue_state, issue_title, issue_url,
         author_login, author_id, comments_count, labels_count, labels_csv,
         created_at, CAST(created_at AS DATE) AS created_date,
         updated_at, CAST(updated_at AS DATE) AS updated_date,
         closed_at, CAST(closed_at AS DATE) AS closed_date,
         time_to_close_hours, issue_age_days, is_stale
  FROM int_issue_lifecycle
)"""

# The mart as day lists: every issue is unnested into the days on which it is
# open, every PR into its created and merged day, and all are counted at once.
MART_PARTS = """
repo_list AS (SELECT repo_full_name FROM fact_issue_aging UNION SELECT repo_full_name FROM fact_pr_cycle_time),
bounds AS (
  SELECT least(min(created_date), {as_of}) AS min_date, {as_of} AS max_date
  FROM (SELECT created_date FROM fact_issue_aging UNION ALL SELECT created_date FROM fact_pr_cycle_time)
),
calendar AS (
  SELECT CAST(unnest(generate_series(CAST(min_date AS TIMESTAMP), CAST(max_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS metric_date,
         repo_full_name
  FROM bounds, repo_list
),
pr_created_daily AS (
  SELECT created_date AS metric_date, repo_full_name, count(*) AS prs_created_count,
         avg(time_to_first_review_hours) AS avg_time_to_first_review_hours
  FROM fact_pr_cycle_time GROUP BY ALL
),
pr_merged_daily AS (
  SELECT CAST(merged_at AS DATE) AS metric_date, repo_full_name, count(*) AS prs_merged_count,
         avg(time_to_merge_hours) AS avg_time_to_merge_hours
  FROM fact_pr_cycle_time WHERE merged_at IS NOT NULL GROUP BY ALL
),
open_days AS (
  SELECT repo_full_name, updated_date,
         CAST(unnest(generate_series(CAST(created_date AS TIMESTAMP), CAST(least(closed_date - 1, {as_of}) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS metric_date
  FROM fact_issue_aging
),
backlog AS (
  SELECT metric_date, repo_full_name, count(*) AS n_open, count(*) FILTER (metric_date - updated_date > {stale}) AS n_stale
  FROM open_days GROUP BY ALL
),
issue_snapshot_daily AS (
  SELECT metric_date, repo_full_name, ifnull(n_open, 0) AS open_issues_count, ifnull(n_stale, 0) AS stale_issues_count
  FROM calendar LEFT JOIN backlog USING (metric_date, repo_full_name)
),
mart_repo_health_daily AS (
  SELECT * REPLACE (ifnull(prs_created_count, 0) AS prs_created_count, ifnull(prs_merged_count, 0) AS prs_merged_count)
  FROM issue_snapshot_daily
  LEFT JOIN pr_created_daily USING (metric_date, repo_full_name)
  LEFT JOIN pr_merged_daily USING (metric_date, repo_full_name)
)"""


def ctes(*blocks: str, pull_filter: str = "", as_of: str = AS_OF, stale: int = STALE_DAYS) -> str:
    body = ",".join(b.format(pull_filter=pull_filter, as_of=as_of, stale=stale) if "{" in b else b
                    for b in blocks)
    return "WITH " + body.strip() + "\n"


PR_CHAIN = (PULL_VERSIONS, REVIEW_VERSIONS, REVIEWS_AGG, PR_LIFECYCLE)
ISSUE_CHAIN = (ISSUE_VERSIONS, ISSUE_LIFECYCLE)
ALL_FACTS = (*PR_CHAIN, FACT_PR, *ISSUE_CHAIN, FACT_ISSUE)
MART = (*ALL_FACTS, MART_PARTS)


def _q(blocks, select: str, **kw) -> str:
    return ctes(*blocks, **kw) + select


ORACLE: dict[str, str] = {
    "stg_pulls": _q((PULL_VERSIONS,), "SELECT * FROM stg_pulls"),
    "stg_issues": _q((ISSUE_VERSIONS,), "SELECT * FROM stg_issues"),
    "stg_reviews": _q((REVIEW_VERSIONS,), "SELECT * FROM stg_reviews WHERE pr_number IS NOT NULL"),
    "int_pr_reviews_agg": _q((REVIEW_VERSIONS, REVIEWS_AGG), "SELECT * FROM int_pr_reviews_agg"),
    "int_pr_lifecycle": _q(PR_CHAIN, "SELECT * FROM int_pr_lifecycle"),
    "int_issue_lifecycle": _q(ISSUE_CHAIN, "SELECT * FROM int_issue_lifecycle"),
    "fact_pr_cycle_time": _q((*PR_CHAIN, FACT_PR), "SELECT * FROM fact_pr_cycle_time"),
    "fact_issue_aging": _q((*ISSUE_CHAIN, FACT_ISSUE), "SELECT * FROM fact_issue_aging"),
    "pr_created_daily": _q(MART, "SELECT * FROM pr_created_daily"),
    "pr_merged_daily": _q(MART, "SELECT * FROM pr_merged_daily"),
    "repo_list": _q(MART, "SELECT * FROM repo_list"),
    "date_bounds": _q(MART, "SELECT * FROM bounds"),
    "calendar": _q(MART, "SELECT * FROM calendar"),
    "open_issues_daily": _q(MART, "SELECT metric_date, repo_full_name, open_issues_count FROM issue_snapshot_daily"),
    "stale_issues_daily": _q(MART, "SELECT metric_date, repo_full_name, stale_issues_count FROM issue_snapshot_daily"),
    "mart_repo_health_daily": _q(MART, "SELECT * FROM mart_repo_health_daily"),
}


ISSUES_KEPT = """
issues_kept AS (
  SELECT * EXCLUDE (src_event_type, src_event_id) FROM issues_typed
  WHERE NOT (src_event_type = 'error' OR (src_event_type = 'view' AND src_event_id % 50 = 0))
)"""

CURSORS = """
cursors AS (
  SELECT e.entity, concat('org/', n.n_name) AS repo_full_name,
         CASE WHEN n.n_nationkey % 5 <> 1 THEN TIMESTAMP '1998-01-01' + to_days(n.n_nationkey) END AS last_updated_at,
         TIMESTAMP '2001-09-10' + to_hours(CAST(n.n_nationkey AS BIGINT)) AS last_success_run,
         TIMESTAMP '2001-09-10' + to_hours(CAST(n.n_nationkey AS BIGINT)) AS updated_at
  FROM nation n, (VALUES ('pulls'), ('issues'), ('pr_reviews')) e(entity)
  WHERE n.n_nationkey % 5 <> 0
),
lookup_p AS (
  SELECT e.entity, r.repo_full_name,
         coalesce(c.last_updated_at, TIMESTAMP '2001-09-15' - INTERVAL 7 DAY) AS since_ts
  FROM (SELECT DISTINCT repo_full_name FROM pulls_typed) r
  CROSS JOIN (VALUES ('pulls'), ('issues'), ('pr_reviews')) e(entity)
  LEFT JOIN cursors c ON c.entity = e.entity AND c.repo_full_name = r.repo_full_name
),
lookup_i AS (
  SELECT r.repo_full_name,
         coalesce(c.last_updated_at, TIMESTAMP '2001-09-15' - INTERVAL 7 DAY) AS since_ts
  FROM (SELECT DISTINCT repo_full_name FROM issues_kept) r
  LEFT JOIN cursors c ON c.entity = 'issues' AND c.repo_full_name = r.repo_full_name
),
changed_pulls AS (
  SELECT f.repo_full_name, f.pr_number, f.updated_at, f.ingestion_date
  FROM pulls_typed f JOIN lookup_p l ON l.entity = 'pulls' AND l.repo_full_name = f.repo_full_name
  WHERE f.updated_at >= l.since_ts
),
changed_for_reviews AS (
  SELECT f.repo_full_name, f.pr_number, f.updated_at
  FROM pulls_typed f JOIN lookup_p l ON l.entity = 'pr_reviews' AND l.repo_full_name = f.repo_full_name
  WHERE f.updated_at >= l.since_ts
),
changed_issues AS (
  SELECT f.repo_full_name, f.updated_at
  FROM issues_kept f JOIN lookup_i l ON l.repo_full_name = f.repo_full_name
  WHERE f.updated_at >= l.since_ts
),
watermarks AS (
  SELECT 'pulls' AS entity, repo_full_name, max(updated_at) AS max_updated_at FROM changed_pulls GROUP BY 2
  UNION ALL
  SELECT 'issues', repo_full_name, max(updated_at) FROM changed_issues GROUP BY 2
  UNION ALL
  SELECT 'pr_reviews', repo_full_name, max(updated_at) FROM changed_for_reviews GROUP BY 2
),
new_cursors AS (
  SELECT entity, repo_full_name, max_updated_at AS last_updated_at,
         TIMESTAMP '2001-09-15' AS last_success_run, TIMESTAMP '2001-09-15' AS updated_at
  FROM watermarks WHERE max_updated_at IS NOT NULL
),
upserted AS (
  SELECT * FROM cursors c
  WHERE NOT EXISTS (SELECT 1 FROM new_cursors n WHERE n.entity = c.entity AND n.repo_full_name = c.repo_full_name)
  UNION ALL
  SELECT * FROM new_cursors
)"""

RAW_DATES = """
raw_dates AS (
  SELECT 'github_pulls_raw' AS source_name, max(CAST(ingestion_date AS TIMESTAMP)) AS max_loaded_at FROM pulls_typed
  UNION ALL
  SELECT 'github_issues_raw', max(CAST(CAST(ts AS DATE) AS TIMESTAMP)) FROM events
  UNION ALL
  SELECT 'github_pr_reviews_raw', max(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)) FROM lineitem
),
fresh AS (
  SELECT o.h AS offset_hours, r.source_name, r.max_loaded_at,
         date_sub('second', r.max_loaded_at, (SELECT max(max_loaded_at) FROM raw_dates) + to_hours(o.h)) AS age_s
  FROM raw_dates r, (VALUES (23), (30), (50)) o(h)
)"""


def _not_null_sql() -> str:
    from repo_pulse.operators.quality import NOT_NULL
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS failing_rows FROM {t}"
        for t, cols in NOT_NULL.items() for c in cols)


def _accepted_sql() -> str:
    from repo_pulse.operators.quality import ACCEPTED_VALUES
    parts = []
    for (t, c), vals in ACCEPTED_VALUES.items():
        lst = ", ".join(f"'{v}'" for v in vals)
        parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                     f"CAST(count_if({c} IS NOT NULL AND {c} NOT IN ({lst})) AS BIGINT) AS failing_rows FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _unique_sql() -> str:
    from repo_pulse.operators.quality import UNIQUE_KEYS
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, (SELECT CAST(count(*) AS BIGINT) FROM "
        f"(SELECT {', '.join(k)} FROM {t} GROUP BY ALL HAVING count(*) > 1)) AS failing_rows"
        for t, k in UNIQUE_KEYS.items())


def _expr_sql() -> str:
    from repo_pulse.operators.quality import EXPRESSIONS
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{e}' AS expression, CAST(count_if(NOT ({e})) AS BIGINT) AS failing_rows FROM {t}"
        for t, es in EXPRESSIONS.items() for e in es)


# Broken rules; least() skips NULLs.
ISSUE_AGE_BAD = "SELECT * FROM fact_issue_aging WHERE least(time_to_close_hours, issue_age_days) < 0"
CYCLE_BAD = "SELECT * FROM fact_pr_cycle_time WHERE least(time_open_hours, time_to_merge_hours, time_to_first_review_hours) < 0"
DATES_BAD = ("SELECT * FROM fact_pr_cycle_time WHERE created_at IS NULL "
             f"OR greatest(created_at, CAST({AS_OF} AS TIMESTAMP)) <> CAST({AS_OF} AS TIMESTAMP) "
             "OR least(merged_at, closed_at, updated_at) < created_at")
REVIEW_BAD = ("SELECT repo_full_name, pr_number, review_id, submitted_at, stg_pulls.created_at FROM stg_pulls "
              "JOIN stg_reviews USING (repo_full_name, pr_number) WHERE stg_pulls.created_at > submitted_at")


def _report_sql() -> str:
    return f"""
SELECT concat('not_null:', column_name) AS check_name, table_name, failing_rows FROM ({_not_null_sql()})
UNION ALL
SELECT concat('accepted_values:', column_name), table_name, failing_rows FROM ({_accepted_sql()})
UNION ALL
SELECT 'unique_combination', table_name, failing_rows FROM ({_unique_sql()})
UNION ALL
SELECT concat('expression_is_true:', expression), table_name, failing_rows FROM ({_expr_sql()})
UNION ALL
SELECT 'issue_age_non_negative', 'fact_issue_aging', CAST(count(*) AS BIGINT) FROM ({ISSUE_AGE_BAD})
UNION ALL
SELECT 'pr_cycle_time_non_negative', 'fact_pr_cycle_time', CAST(count(*) AS BIGINT) FROM ({CYCLE_BAD})
UNION ALL
SELECT 'pr_dates_valid', 'fact_pr_cycle_time', CAST(count(*) AS BIGINT) FROM ({DATES_BAD})
UNION ALL
SELECT 'review_after_pr_creation', 'stg_reviews', CAST(count(*) AS BIGINT) FROM ({REVIEW_BAD})
"""


LANDED_DATE = "CASE WHEN v = 0 THEN DATE '2024-02-29' ELSE DATE '2024-03-01' END"
DASH_REPOS = "('org/NATION_1', 'org/NATION_2', 'org/NATION_3', 'org/NATION_4', 'org/NATION_5')"

ORACLE.update({
    "scan_landing": _q((PULL_VERSIONS,), f"SELECT {LANDED_DATE} AS ingestion_date, repo_full_name, "
                       "'pull' AS event_type, pr_number, updated_at FROM pull_versions"),
    "envelope_build": _q((PULL_VERSIONS,), f"SELECT {AS_OF} AS ingestion_date, repo_full_name, 'pull' AS event_type, "
                         "pr_number, updated_at FROM pulls_typed"),
    "landing_roundtrip": _q((PULL_VERSIONS,), f"SELECT {LANDED_DATE} AS ingestion_date, repo_full_name, "
                            f"'pull' AS event_type, CAST({LANDED_DATE} AS VARCHAR) AS dt, "
                            "replace(repo_full_name, '/', '__') AS repo, "
                            "CASE WHEN v = 0 THEN 'run-1' ELSE 'run-2' END AS run_id, pr_number, updated_at "
                            "FROM pull_versions"),
    "raw_append": _q((PULL_VERSIONS,), "SELECT ingestion_date, repo_full_name, 'pull' AS event_type, pr_number, "
                     "updated_at FROM pulls_typed"),
    "json_scalar_paths": _q((PULL_VERSIONS,), "SELECT ingestion_date, repo_full_name, pr_number, pull_request_node_id, "
                            "pull_request_title, pull_request_url, base_branch, head_branch, author_login FROM pulls_typed"),
    "safe_casts": _q((PULL_VERSIONS,), "SELECT ingestion_date, repo_full_name, pr_number, pull_request_id, is_draft, "
                     "author_id, additions_count, commits_count, created_at, updated_at, closed_at, merged_at "
                     "FROM pulls_typed"),
    "parse_iso_ts": _q((ISSUE_VERSIONS,), "SELECT ingestion_date, repo_full_name, issue_number, updated_at "
                       "FROM issues_typed"),
    "latest_version": _q((REVIEW_VERSIONS,), "SELECT repo_full_name, review_id, ingestion_date, updated_at, "
                         "review_state, pr_number FROM stg_reviews"),
    "full_load": _q((PULL_VERSIONS,), "SELECT repo_full_name, pr_number, updated_at, ingestion_date FROM pulls_typed"),
    "split_issue_feed": _q((ISSUE_VERSIONS, ISSUES_KEPT), "SELECT ingestion_date, repo_full_name, issue_number, "
                           "updated_at FROM issues_kept"),
    "json_array_length": _q((ISSUE_VERSIONS, ISSUES_KEPT), "SELECT ingestion_date, repo_full_name, issue_number, "
                            "updated_at, labels_count FROM issues_kept"),
    "labels_csv": _q((ISSUE_VERSIONS, ISSUES_KEPT), "SELECT ingestion_date, repo_full_name, issue_number, updated_at, "
                     "labels_csv FROM issues_kept"),
    "review_pr_number": _q((REVIEW_VERSIONS,), "SELECT ingestion_date, repo_full_name, review_id, pr_number, "
                           "updated_at FROM reviews_typed"),
    "pr_left_join_reviews": _q((PULL_VERSIONS, REVIEW_VERSIONS, REVIEWS_AGG),
                               "SELECT p.repo_full_name, p.pr_number, p.created_at, r.first_review_at, r.review_count, "
                               "r.unique_reviewer_count FROM stg_pulls p LEFT JOIN int_pr_reviews_agg r "
                               "ON p.repo_full_name = r.repo_full_name AND p.pr_number = r.pr_number"),
    "cursor_lookup": _q((PULL_VERSIONS, ISSUE_VERSIONS, ISSUES_KEPT, CURSORS), "SELECT * FROM lookup_p"),
    "changed_since_cursor": _q((PULL_VERSIONS, ISSUE_VERSIONS, ISSUES_KEPT, CURSORS), "SELECT * FROM changed_pulls"),
    "reviews_of_changed_prs": _q((PULL_VERSIONS, REVIEW_VERSIONS, ISSUE_VERSIONS, ISSUES_KEPT, CURSORS),
                                 "SELECT r.repo_full_name, r.pr_number, r.review_id, r.ingestion_date, r.updated_at "
                                 "FROM reviews_typed r WHERE EXISTS (SELECT 1 FROM changed_for_reviews c "
                                 "WHERE c.repo_full_name = r.repo_full_name AND c.pr_number = r.pr_number)"),
    "watermark_max": _q((PULL_VERSIONS, ISSUE_VERSIONS, ISSUES_KEPT, CURSORS), "SELECT * FROM watermarks"),
    "cursor_upsert": _q((PULL_VERSIONS, ISSUE_VERSIONS, ISSUES_KEPT, CURSORS), "SELECT * FROM upserted"),
    "new_data_gate": _q((PULL_VERSIONS, ISSUE_VERSIONS, ISSUES_KEPT, CURSORS), f"""
SELECT s.scenario, CAST(count(u.entity) AS BIGINT) AS updated_cursor_count
FROM (VALUES ('none', FALSE), ('empty', FALSE), ('five', TRUE)) s(scenario, use_list)
LEFT JOIN upserted u
  ON u.entity IN ('pulls', 'issues', 'pr_reviews') AND u.updated_at >= TIMESTAMP '2001-09-10 12:00:00'
 AND (NOT s.use_list OR u.repo_full_name IN {DASH_REPOS})
GROUP BY s.scenario"""),
    "source_freshness": _q((PULL_VERSIONS, RAW_DATES), """
SELECT CAST(offset_hours AS BIGINT) AS offset_hours, source_name, max_loaded_at, age_s / 3600.0 AS age_hours,
       CASE WHEN age_s > 48 * 3600 THEN 'error' WHEN age_s > 24 * 3600 THEN 'warn' ELSE 'pass' END AS status
FROM fresh"""),
    "discounted_amount": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, l_discount,
       CAST(-1 * CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(15,2)) AS DECIMAL(38,9))
         AS discounted_amount
FROM lineitem""",
    "dq_not_null": _q(MART, _not_null_sql()),
    "dq_accepted_values": _q(MART, _accepted_sql()),
    "dq_unique_combination": _q(MART, _unique_sql()),
    "dq_expression": _q(MART, _expr_sql()),
    "dq_issue_age": _q((*ISSUE_CHAIN, FACT_ISSUE), ISSUE_AGE_BAD),
    "dq_cycle_time": _q((*PR_CHAIN, FACT_PR), CYCLE_BAD),
    "dq_pr_dates": _q((*PR_CHAIN, FACT_PR), DATES_BAD),
    "dq_review_before_creation": _q((PULL_VERSIONS, REVIEW_VERSIONS), REVIEW_BAD),
    "dq_report": _q(MART, _report_sql()),
    "dash_pr_series": _q(MART, "SELECT metric_date, CAST(sum(prs_created_count) AS BIGINT) AS prs_created_count, "
                         "CAST(sum(prs_merged_count) AS BIGINT) AS prs_merged_count "
                         "FROM mart_repo_health_daily GROUP BY 1"),
    "dash_issue_series": _q(MART, "SELECT metric_date, CAST(sum(open_issues_count) AS BIGINT) AS open_issues_count, "
                            "CAST(sum(stale_issues_count) AS BIGINT) AS stale_issues_count "
                            "FROM mart_repo_health_daily GROUP BY 1"),
    "dash_scorecards": _q(MART, "SELECT round(avg(avg_time_to_first_review_hours), 4) AS avg_time_to_first_review_hours, "
                          "round(avg(avg_time_to_merge_hours), 4) AS avg_time_to_merge_hours "
                          "FROM mart_repo_health_daily"),
    "top_stale_repos": _q(MART, "SELECT repo_full_name, metric_date, stale_issues_count, open_issues_count "
                          "FROM mart_repo_health_daily "
                          "WHERE metric_date = (SELECT max(metric_date) FROM mart_repo_health_daily) "
                          "ORDER BY stale_issues_count DESC, repo_full_name ASC"),
    "dash_filtered": _q(MART, "SELECT * FROM mart_repo_health_daily WHERE metric_date BETWEEN DATE '2024-01-01' "
                        f"AND DATE '2024-02-29' AND repo_full_name IN {DASH_REPOS}"),
})


HIST_COLS = ("concat(repo_full_name, '-', CAST(pr_number AS VARCHAR)) AS snapshot_key, repo_full_name, pr_number, "
             "pull_request_id, pull_request_state, pull_request_title, author_login, is_draft, created_at, "
             "updated_at, closed_at, merged_at, "
             "md5(concat(repo_full_name, '-', CAST(pr_number AS VARCHAR), '|', CAST(updated_at AS VARCHAR))) "
             "AS version_id, updated_at AS valid_from")
FROM_HISTORY = f"""
hist_versions AS (
  SELECT * FROM pulls_typed
  WHERE pr_number IS NOT NULL AND updated_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY repo_full_name, pr_number, updated_at
                             ORDER BY ingestion_date DESC NULLS LAST) = 1
),
from_history AS (
  SELECT {HIST_COLS},
         lead(updated_at) OVER (PARTITION BY repo_full_name, pr_number ORDER BY updated_at) AS valid_to
  FROM hist_versions
)"""
BATCH2_TOUCHED = ("EXISTS (SELECT 1 FROM pulls_typed b WHERE b.ingestion_date >= DATE '2000-01-01' "
                  "AND b.repo_full_name = s.repo_full_name AND b.pr_number = s.pr_number)")

ORACLE.update({
    "lookback_filter": _q((PULL_VERSIONS,), "SELECT repo_full_name, pr_number, updated_at, ingestion_date, "
                          "pull_request_state FROM stg_pulls WHERE updated_at >= (SELECT max(updated_at) "
                          "FROM pulls_typed WHERE ingestion_date < DATE '2000-01-01') - INTERVAL 1 DAY"),
    "upsert_by_key": _q((PULL_VERSIONS,), "SELECT * FROM stg_pulls"),
    "upsert_duplicate_keys": _q((PULL_VERSIONS,), "SELECT repo_full_name, pr_number, CAST(count(*) AS BIGINT) "
                                "AS n_rows FROM pulls_typed GROUP BY ALL HAVING count(*) > 1"),
    "reviews_agg_incremental": _q((REVIEW_VERSIONS, REVIEWS_AGG), "SELECT * FROM int_pr_reviews_agg"),
    "pr_lifecycle_incremental": _q(PR_CHAIN, "SELECT * FROM int_pr_lifecycle"),
    "fact_pr_incremental": _q((*PR_CHAIN, FACT_PR), "SELECT * FROM fact_pr_cycle_time"),
    "issue_lifecycle_incremental": _q(ISSUE_CHAIN, "SELECT * FROM int_issue_lifecycle"),
    "fact_issue_incremental": _q((*ISSUE_CHAIN, FACT_ISSUE), "SELECT * FROM fact_issue_aging"),
    "mart_from_raw": _q(MART, "SELECT * FROM mart_repo_health_daily"),
    "dq_violations": _q(MART, """
SELECT 'issue_age' AS check_name, repo_full_name, issue_number AS number, CAST(1 AS BIGINT) AS n_rows
FROM fact_issue_aging WHERE issue_number % 50 = 0 OR least(time_to_close_hours, issue_age_days) < 0
UNION ALL
SELECT 'pr_dates', repo_full_name, pr_number, 1 FROM fact_pr_cycle_time
WHERE pr_number % 50 < 3 OR created_at IS NULL OR least(merged_at, closed_at, updated_at) < created_at
UNION ALL
SELECT 'unique', repo_full_name, issue_number, 2 FROM stg_issues WHERE issue_number % 100 = 7"""),
    "mart_incremental": _q(MART, "SELECT * FROM mart_repo_health_daily"),
    "int_partitions_roundtrip": _q(PR_CHAIN, "SELECT * FROM int_pr_lifecycle"),
    "job_two_runs": _q(MART, "SELECT * FROM mart_repo_health_daily"),
    "schema_sync_upsert": _q((PULL_VERSIONS,), "SELECT s.* REPLACE (CASE WHEN " + BATCH2_TOUCHED +
                             " THEN s.head_branch END AS head_branch) FROM stg_pulls s"),
    "partitioned_roundtrip": _q((*PR_CHAIN, FACT_PR), "SELECT * FROM fact_pr_cycle_time"),
    "scd2_merge": _q((PULL_VERSIONS,), f"SELECT {HIST_COLS}, CASE WHEN v = 0 THEN lead(updated_at) OVER "
                     "(PARTITION BY repo_full_name, pr_number ORDER BY v) END AS valid_to FROM pull_versions"),
    "scd2_hard_delete": _q((PULL_VERSIONS,), f"SELECT {HIST_COLS}, CASE WHEN pr_number % 10 = 0 THEN "
                           "TIMESTAMP '2024-03-01 00:00:00' END AS valid_to FROM stg_pulls"),
    "scd2_from_history": _q((PULL_VERSIONS, FROM_HISTORY), "SELECT * FROM from_history"),
    "scd2_as_of": _q((PULL_VERSIONS, FROM_HISTORY), "SELECT * FROM from_history WHERE valid_from <= "
                     "TIMESTAMP '1999-01-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1999-01-01')"),
    "stream_latest_version": _q((ISSUE_VERSIONS,), "SELECT * FROM stg_issues"),
    "stream_daily_counts": _q((ISSUE_VERSIONS, ISSUES_KEPT), "SELECT CAST(updated_at AS DATE) AS metric_date, "
                              "repo_full_name, CAST(count(*) AS BIGINT) AS issue_events_count FROM issues_kept "
                              "WHERE updated_at IS NOT NULL GROUP BY ALL"),
    "stream_resumed_counts": _q((ISSUE_VERSIONS, ISSUES_KEPT), "SELECT CAST(updated_at AS DATE) AS metric_date, "
                              "repo_full_name, CAST(count(*) AS BIGINT) AS issue_events_count FROM issues_kept "
                              "WHERE updated_at IS NOT NULL GROUP BY ALL"),
    "stream_dedup": _q((ISSUE_VERSIONS, ISSUES_KEPT), "SELECT DISTINCT repo_full_name, issue_number, updated_at, "
                       "ingestion_date FROM issues_kept WHERE updated_at IS NOT NULL"),
})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
