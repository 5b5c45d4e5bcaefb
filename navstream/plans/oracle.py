"""DuckDB SQL equivalents of the registered queries (tables are the shared test tables).

Written independently of the Spark code: the same semantics stated as plain SQL, so a mismatch
points at a real difference.
"""

from __future__ import annotations

CLICKSTREAM = r"""
clickstream AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS prev,
         CAST(l_partkey AS VARCHAR) AS curr,
         CASE l_returnflag WHEN 'A' THEN 'link' WHEN 'N' THEN 'external' ELSE 'other' END AS type,
         CAST(l_quantity AS BIGINT) AS n,
         substr(CAST(l_shipdate AS VARCHAR), 1, 7) AS month
  FROM lineitem
)"""

DIRTY = r"""
dirty AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN '  '
              ELSE CAST(l_suppkey AS VARCHAR) END AS prev,
         CASE WHEN l_orderkey % 83 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS curr,
         CASE WHEN l_orderkey % 79 = 0 THEN NULL WHEN l_orderkey % 73 = 0 THEN 'bogus'
              WHEN l_returnflag = 'A' THEN 'link' WHEN l_returnflag = 'N' THEN 'external' ELSE 'other' END AS type,
         CASE WHEN l_orderkey % 71 = 0 THEN NULL WHEN l_orderkey % 67 = 0 THEN -1
              ELSE CAST(l_quantity AS BIGINT) END AS n,
         CASE WHEN l_orderkey % 61 = 0 THEN '' ELSE substr(CAST(l_shipdate AS VARCHAR), 1, 7) END AS month
  FROM lineitem
)"""


def _flagged(source: str) -> str:
    return rf"""
flagged AS (
  SELECT *,
         coalesce(prev IS NULL OR trim(prev) = '', true) AS v_prev,
         coalesce(curr IS NULL OR trim(curr) = '', true) AS v_curr,
         coalesce(NOT (type IN ('link', 'external', 'other')), true) AS v_type,
         coalesce(n <= 0, true) AS v_n,
         coalesce(month IS NULL OR NOT regexp_matches(month, '^\d{{4}}-\d{{2}}$'), true) AS v_month
  FROM {source}
),
checked AS (
  SELECT prev, curr, type, n, month,
         (v_prev OR v_curr OR v_type OR v_n OR v_month) AS bad,
         concat_ws('|', CASE WHEN v_prev THEN 'null_prev' END, CASE WHEN v_curr THEN 'null_curr' END,
                        CASE WHEN v_type THEN 'bad_type' END, CASE WHEN v_n THEN 'neg_n' END,
                        CASE WHEN v_month THEN 'bad_month' END) AS _reason
  FROM flagged
)"""


CLEAN = f"WITH {CLICKSTREAM},{_flagged('clickstream')},\nclean AS (SELECT prev, curr, type, n, month FROM checked WHERE NOT bad)"
# The batch job runs on the dirty dump: its marts come from the clean side of that contract.
DIRTY_CLEAN = f"WITH {DIRTY},{_flagged('dirty')},\nclean AS (SELECT prev, curr, type, n, month FROM checked WHERE NOT bad)"
DQ = f"WITH {DIRTY},{_flagged('dirty')}"

INDEGREE = """
indegree AS (
  SELECT month, curr, total_clicks FROM (
    SELECT month, curr, CAST(sum(n) AS BIGINT) AS total_clicks,
           row_number() OVER (PARTITION BY month ORDER BY sum(n) DESC, curr ASC NULLS LAST) AS rn
    FROM clean GROUP BY month, curr)
  WHERE rn <= 50
)"""

OUTDEGREE = """
outdegree AS (
  SELECT month, prev, total_clicks_sent, unique_targets FROM (
    SELECT month, prev, CAST(sum(n) AS BIGINT) AS total_clicks_sent, count(DISTINCT curr) AS unique_targets,
           row_number() OVER (PARTITION BY month ORDER BY sum(n) DESC, prev ASC NULLS LAST) AS rn
    FROM clean WHERE type = 'link' GROUP BY month, prev)
  WHERE rn <= 50
)"""

PAIRS = """
pairs AS (
  SELECT month, prev, curr, total_clicks FROM (
    SELECT month, prev, curr, CAST(sum(n) AS BIGINT) AS total_clicks,
           row_number() OVER (PARTITION BY month
                              ORDER BY sum(n) DESC, prev ASC NULLS LAST, curr ASC NULLS LAST) AS rn
    FROM clean WHERE type = 'link' GROUP BY month, prev, curr)
  WHERE rn <= 50
)"""

TREND = """
trend AS (SELECT month, curr, CAST(sum(n) AS BIGINT) AS monthly_clicks FROM clean GROUP BY month, curr)"""

EDITS = """
edits AS (
  SELECT event_id,
         CASE WHEN user_id % 4 = 0 THEN 'dewiki' WHEN user_id % 4 = 1 THEN 'frwiki' ELSE 'enwiki' END AS wiki,
         concat('page_', CAST(user_id % 50 AS VARCHAR)) AS title,
         CAST(user_id AS VARCHAR) AS "user",
         event_type AS type,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 7 = 0 END AS bot,
         ts AS event_time,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(floor(value) AS INTEGER) - 50 END AS size_delta,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id END AS rev_new,
         props AS comment,
         CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s
  FROM events
)"""

# Edits after a trip through the bus: the payload carries whole epoch seconds.
SILVER = EDITS + """,
silver AS (
  SELECT event_id,
         CASE WHEN rev_new IS NOT NULL AND rev_new <> 0 AND wiki IS NOT NULL AND wiki <> ''
              THEN wiki || ':' || CAST(rev_new AS VARCHAR)
              ELSE coalesce(wiki, '') || ':' || coalesce(CAST(epoch_s AS VARCHAR), '') || ':' || coalesce(title, '')
         END AS event_key,
         wiki, title, "user", type, bot, date_trunc('second', event_time) AS event_time,
         CAST(size_delta AS BIGINT) AS size_delta, comment
  FROM edits
)"""

SILVER_COLUMNS = 'event_key, wiki, title, "user", type, bot, event_time, size_delta, comment'


def _rate(source: str, width: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL '{width}', event_time) AS window_start,
       time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS window_end,
       wiki, count(*) AS edit_count,
       CAST(sum(CASE WHEN bot THEN 1 ELSE 0 END) AS BIGINT) AS bot_edits,
       avg(size_delta) AS avg_size_delta
FROM {source} GROUP BY ALL"""


def _types(source: str, width: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL '{width}', event_time) AS window_start, type, count(*) AS "count"
FROM {source} GROUP BY ALL"""


def _editors(source: str, width_minutes: int, slide_minutes: int) -> str:
    steps = width_minutes // slide_minutes
    return f"""
SELECT time_bucket(INTERVAL '{slide_minutes} minutes', event_time) - to_minutes(CAST(k * {slide_minutes} AS BIGINT))
         AS window_start,
       "user", wiki, count(*) AS edit_count
FROM {source}, range(0, {steps}) AS r(k)
WHERE bot = false
GROUP BY ALL"""


def _closed(select: str, width: str) -> str:
    """Windows an append-mode stream has emitted: end at or before max(event time) - 5 minutes."""
    return f"""
SELECT * FROM ({select}) AS w
WHERE w.window_start + INTERVAL '{width}' <= (SELECT max(event_time) FROM silver) - INTERVAL '5 minutes'"""


# What the second delivery of the re-run leaves clean.
RERUN = f"""WITH {CLICKSTREAM},
again AS (
  SELECT prev, curr, CASE WHEN month = '1996-07' THEN 'external' ELSE type END AS type,
         CASE WHEN month = '1995-03' THEN -n ELSE n END AS n, month
  FROM clickstream
),{_flagged('again')},
clean AS (SELECT prev, curr, type, n, month FROM checked WHERE NOT bad)"""

# Clean edges in which the excluded titles are the most clicked targets.
SPECIAL = f"""WITH {CLICKSTREAM},{_flagged('clickstream')},
clean AS (
  SELECT prev, CASE CAST(curr AS BIGINT) % 50 WHEN 0 THEN 'Main_Page' WHEN 1 THEN 'Hyphen-minus' ELSE curr END AS curr,
         type, n, month
  FROM checked WHERE NOT bad)"""

DUMPS = """
dumps AS (
  SELECT CASE WHEN l_orderkey % 47 = 0 THEN '"' || CAST(l_suppkey AS VARCHAR)
              WHEN l_orderkey % 43 = 0 THEN '"' || CAST(l_suppkey AS VARCHAR) || '"'
              ELSE CAST(l_suppkey AS VARCHAR) END AS prev,
         CAST(l_partkey AS VARCHAR) AS curr,
         CASE l_returnflag WHEN 'A' THEN 'link' WHEN 'N' THEN 'external' ELSE 'other' END AS type,
         CASE WHEN l_orderkey % 53 <> 0 THEN CAST(l_quantity AS BIGINT) END AS n,
         substr(CAST(l_shipdate AS VARCHAR), 1, 7) AS month
  FROM lineitem
)"""

ORACLE: dict[str, str] = {
    "top_articles_indegree": f"{CLEAN},{INDEGREE}\nSELECT * FROM indegree",
    "top_articles_outdegree": f"{CLEAN},{OUTDEGREE}\nSELECT * FROM outdegree",
    "top_link_pairs": f"{CLEAN},{PAIRS}\nSELECT * FROM pairs",
    "monthly_trend": f"{CLEAN},{TREND}\nSELECT * FROM trend ORDER BY curr, month",
    "months_loaded": f"{CLEAN}\nSELECT DISTINCT month FROM clean ORDER BY month",
    "month_picker": f"{CLEAN},{INDEGREE}\nSELECT DISTINCT month FROM indegree WHERE month IS NOT NULL ORDER BY month DESC",
    "month_coverage": rf"""{CLEAN},
counts AS (
  SELECT month, count(*) AS rows FROM clean
  WHERE regexp_matches(month, '^\d{{4}}-\d{{2}}$') AND try_strptime(month || '-01', '%Y-%m-%d') IS NOT NULL
  GROUP BY month),
span AS (SELECT min(month) AS lo, max(month) AS hi FROM counts),
calendar AS (
  SELECT strftime(d, '%Y-%m') AS month
  FROM span, range(strptime(lo || '-01', '%Y-%m-%d'), strptime(hi || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH,
                   INTERVAL 1 MONTH) AS t(d)
  UNION
  SELECT unnest(['2024-10', '2024-11', '2024-12', '2025-01', '2025-02', '2025-03']))
SELECT calendar.month, CAST(coalesce(counts.rows, 0) AS BIGINT) AS rows, counts.rows IS NOT NULL AS loaded
FROM calendar LEFT JOIN counts ON calendar.month = counts.month""",
    "clickstream_row_count": f"{CLEAN}\nSELECT count(*) AS rows FROM clean",
    "dq_clean": f"{DQ}\nSELECT prev, curr, type, n, month FROM checked WHERE NOT bad",
    "dq_quarantine": f"{DQ}\nSELECT prev, curr, type, n, month, _reason FROM checked WHERE bad",
    "dq_counts": f"""{DQ}
SELECT count(*) AS raw_rows, count(*) FILTER (WHERE NOT bad) AS clean_rows,
       count(*) FILTER (WHERE bad) AS quarantined_rows
FROM checked""",
    "dq_reason_counts": f'{DQ}\nSELECT month, _reason, count(*) AS "count" FROM checked WHERE bad GROUP BY month, _reason',
    "dq_summary": f"""{DQ}
SELECT month, _reason, count(*) AS "count" FROM checked WHERE bad GROUP BY month, _reason
ORDER BY month ASC NULLS FIRST, "count" DESC, _reason ASC""",
    "dash_top_in": f"""{CLEAN},{INDEGREE}
SELECT month, curr, total_clicks FROM indegree
WHERE month = (SELECT max(month) FROM indegree) AND coalesce(curr NOT IN ('Main_Page', 'Hyphen-minus'), true)
ORDER BY total_clicks DESC, curr ASC NULLS LAST LIMIT 20""",
    "dash_top_out": f"""{CLEAN},{OUTDEGREE}
SELECT month, prev, total_clicks_sent, unique_targets FROM outdegree
WHERE month = (SELECT max(month) FROM outdegree)
ORDER BY total_clicks_sent DESC, prev ASC NULLS LAST LIMIT 20""",
    "dash_top_pairs": f"""{CLEAN},{PAIRS}
SELECT month, prev, curr, total_clicks, prev || '  →  ' || curr AS link FROM pairs
WHERE month = (SELECT max(month) FROM pairs)
ORDER BY total_clicks DESC, prev ASC NULLS LAST, curr ASC NULLS LAST LIMIT 20""",
    "dash_trend_top10": f"""{CLEAN},{TREND},
leaders AS (
  SELECT curr FROM trend WHERE coalesce(curr NOT IN ('Main_Page', 'Hyphen-minus'), true)
  GROUP BY curr ORDER BY sum(monthly_clicks) DESC, curr ASC NULLS LAST LIMIT 10)
SELECT month, curr, monthly_clicks FROM trend WHERE curr IN (SELECT curr FROM leaders) ORDER BY month, curr""",
    "edits_per_wiki_per_minute": f"WITH {EDITS}{_rate('edits', '1 minute')}",
    "edits_per_wiki_per_hour": f"WITH {EDITS}{_rate('edits', '1 hour')}",
    "edit_type_breakdown": f"WITH {EDITS}{_types('edits', '1 minute')}",
    "edit_type_breakdown_hourly": f"WITH {EDITS}{_types('edits', '1 hour')}",
    "top_editors_sliding": f"WITH {EDITS}{_editors('edits', 5, 1)}",
    "top_editors_sliding_hourly": f"WITH {EDITS}{_editors('edits', 300, 60)}",
    "edit_message_key": f"WITH {SILVER}\nSELECT event_id, event_key FROM silver",
    "edit_silver": f"WITH {SILVER}\nSELECT {SILVER_COLUMNS} FROM silver",
    "edits_dedup_batch": f"WITH {SILVER}\nSELECT {SILVER_COLUMNS} FROM silver",
    "edit_kpis": f"""WITH {EDITS},
rate AS ({_rate('edits', '1 minute')})
SELECT CAST(coalesce(sum(edit_count), 0) AS BIGINT) AS total_edits,
       CAST(coalesce(sum(bot_edits), 0) AS BIGINT) AS total_bots,
       CASE WHEN coalesce(sum(edit_count), 0) > 0
            THEN CAST(sum(bot_edits) AS DOUBLE) / CAST(sum(edit_count) AS DOUBLE) * 100 ELSE 0.0 END AS bot_pct,
       max(window_start) AS latest_window
FROM rate""",
    "edit_type_totals": f"""WITH {EDITS},
breakdown AS ({_types('edits', '1 minute')})
SELECT type, CAST(sum("count") AS BIGINT) AS "count" FROM breakdown GROUP BY type""",
    "edit_rate_series": f"""WITH {EDITS},
rate AS ({_rate('edits', '1 minute')})
SELECT window_start, edit_count, bot_edits FROM rate WHERE wiki = 'enwiki' ORDER BY window_start""",
    "top_editors_latest_window": f"""WITH {EDITS},
editors AS ({_editors('edits', 5, 1)})
SELECT * FROM editors WHERE window_start = (SELECT max(window_start) FROM editors)
ORDER BY edit_count DESC, "user" ASC NULLS LAST, wiki ASC NULLS LAST LIMIT 15""",
    "edits_per_wiki_stream": f"WITH {SILVER}{_closed(_rate('silver', '1 hour'), '1 hour')}",
    "edit_type_stream": f"WITH {SILVER}{_closed(_types('silver', '1 minute'), '1 minute')}",
    "top_editors_stream": f"WITH {SILVER}{_closed(_editors('silver', 5, 1), '5 minutes')}",
    "edits_dedup_stream": f"WITH {SILVER}\nSELECT {SILVER_COLUMNS} FROM silver",
    "edits_per_wiki_stream_silver_first": f"WITH {SILVER}{_closed(_rate('silver', '1 hour'), '1 hour')}",
    "job_top_articles_indegree": f"{DIRTY_CLEAN},{INDEGREE}\nSELECT * FROM indegree",
    "job_top_articles_outdegree": f"{DIRTY_CLEAN},{OUTDEGREE}\nSELECT * FROM outdegree",
    "job_top_link_pairs": f"{DIRTY_CLEAN},{PAIRS}\nSELECT * FROM pairs",
    "job_monthly_trend": f"{DIRTY_CLEAN},{TREND}\nSELECT * FROM trend",
    "job_quarantine_reasons": f"""{DQ}
SELECT nullif(month, '') AS month, _reason, count(*) AS "count" FROM checked WHERE bad GROUP BY ALL""",
    "rerun_monthly_trend": f"{RERUN},{TREND}\nSELECT * FROM trend",
    "rerun_boards": f"""{RERUN},{INDEGREE},{OUTDEGREE},{PAIRS}
SELECT 'in' AS board, month, NULL::VARCHAR AS prev, curr, total_clicks AS clicks FROM indegree
UNION ALL SELECT 'out', month, prev, NULL, total_clicks_sent FROM outdegree
UNION ALL SELECT 'pair', month, prev, curr, total_clicks FROM pairs""",
    "quarantine_step": f"{DQ}\nSELECT nullif(month, '') AS month, prev, curr, type, n, _reason FROM checked WHERE bad",
    "serve_top_in": f"""{SPECIAL},{INDEGREE}
SELECT month, curr, total_clicks FROM indegree
WHERE month = (SELECT max(month) FROM indegree) AND curr NOT IN ('Main_Page', 'Hyphen-minus')
ORDER BY total_clicks DESC, curr LIMIT 20""",
    "serve_top_in_month": f"""{SPECIAL},{INDEGREE}
SELECT month, curr, total_clicks FROM indegree
WHERE month = '1995-03' AND curr NOT IN ('Main_Page', 'Hyphen-minus')
ORDER BY total_clicks DESC, curr LIMIT 20""",
    "serve_month_picker": f"{SPECIAL},{INDEGREE}\nSELECT DISTINCT month FROM indegree ORDER BY month DESC",
    "serve_top_out_month": f"""{SPECIAL},{OUTDEGREE}
SELECT month, prev, total_clicks_sent, unique_targets FROM outdegree WHERE month = '1995-03'
ORDER BY total_clicks_sent DESC, prev LIMIT 20""",
    "serve_top_pairs_month": f"""{SPECIAL},{PAIRS}
SELECT month, prev, curr, total_clicks, prev || '  →  ' || curr AS link FROM pairs WHERE month = '1995-03'
ORDER BY total_clicks DESC, prev, curr LIMIT 20""",
    "serve_trend_top10": f"""{SPECIAL},{TREND},
leaders AS (
  SELECT curr FROM trend WHERE curr NOT IN ('Main_Page', 'Hyphen-minus')
  GROUP BY curr ORDER BY sum(monthly_clicks) DESC, curr LIMIT 10)
SELECT month, curr, monthly_clicks FROM trend WHERE curr IN (SELECT curr FROM leaders) ORDER BY month, curr""",
    "serve_top_editors": f"""WITH {EDITS},
editors AS ({_editors('edits', 1440, 720)})
SELECT * FROM editors WHERE window_start = (SELECT max(window_start) FROM editors)
ORDER BY edit_count DESC, "user" ASC NULLS LAST, wiki ASC NULLS LAST LIMIT 15""",
    "tsv_scan": f"WITH {DUMPS}\nSELECT * FROM dumps",
    "tsv_missing_months": f"""WITH {DUMPS}
SELECT month FROM (SELECT unnest(['2024-10', '2024-11', '2024-12', '2025-01', '2025-02', '2025-03', '1992-01', '1995-03']) AS month)
WHERE month NOT IN (SELECT month FROM dumps)""",
    "edit_silver_dirty": f"""WITH {SILVER}
SELECT {SILVER_COLUMNS} FROM silver
WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 AND event_id % 29 <> 0""",
    "edits_only_wiki": f"WITH {SILVER}\nSELECT {SILVER_COLUMNS} FROM silver WHERE wiki = 'enwiki'",
    "edits_dedup_stream_slices": f"WITH {SILVER}\nSELECT {SILVER_COLUMNS} FROM silver",
    "edits_per_wiki_stream_slices": f"WITH {SILVER}{_closed(_rate('silver', '1 hour'), '1 hour')}",
    "job_status_counts": f"""{DQ}
SELECT CASE WHEN bad THEN 'quarantine' ELSE 'clean' END AS status, count(*) AS rows FROM checked GROUP BY ALL""",
}
