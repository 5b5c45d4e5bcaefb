"""DuckDB SQL equivalents of the queries in ``live_catalog``, stated as full recomputations."""

from __future__ import annotations

from navstream.plans.oracle import CLEAN, CLICKSTREAM, EDITS, INDEGREE, OUTDEGREE, PAIRS, SILVER, TREND, _editors, _flagged, _rate

# Six slices in order of time; what the feed delivers in each, and the watermark (one day behind what came before it).
OUTCOMES = f"""WITH {SILVER},
span AS (SELECT min(epoch_s) AS low, (max(epoch_s) - min(epoch_s)) // 6 + 1 AS width FROM edits),
own AS (
  SELECT silver.event_id, event_key, silver.event_time, wiki, epoch_s, low, width, CAST((epoch_s - low) // width AS INTEGER) AS slice
  FROM silver JOIN edits USING (event_id, wiki), span
),
marks AS (SELECT slice, max(epoch_s) AS latest FROM own GROUP BY slice),
again AS (
  SELECT own.*, (SELECT max(latest) FROM marks WHERE marks.slice <= own.slice) - 86400 AS watermark
  FROM own WHERE (event_id % 10 = 0 OR epoch_s > low + (slice + 1) * width - 86400) AND slice < 5
)
SELECT event_key, event_time, wiki, 'kept' AS outcome FROM own
UNION ALL SELECT event_key, event_time, wiki, CASE WHEN epoch_s <= watermark THEN 'late' ELSE 'duplicate' END FROM again"""


def _first_editors(width_minutes: int, slide_minutes: int, n: int) -> str:
    return f"""WITH {EDITS}, counted AS ({_editors('edits', width_minutes, slide_minutes)})
SELECT window_start, "user", wiki, edit_count FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY edit_count DESC, "user" NULLS LAST, wiki NULLS LAST) AS rn FROM counted)
WHERE rn <= {n}"""


# All months as they stand after the second delivery.
CORRECTED = f"""WITH delivered AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS prev, CAST(l_partkey AS VARCHAR) AS curr,
         CASE l_returnflag WHEN 'A' THEN 'link' WHEN 'N' THEN 'external' ELSE 'other' END AS type,
         CAST(l_quantity AS BIGINT) AS n, substr(CAST(l_shipdate AS VARCHAR), 1, 7) AS month, l_orderkey AS k
  FROM lineitem
),
corrected AS (
  SELECT prev, curr, type, n + CASE WHEN month = '1995-03' AND k % 5 = 0 THEN 1 ELSE 0 END AS n, month
  FROM delivered WHERE month <> '1996-07' AND NOT (month = '1995-03' AND k % 3 = 0)
),{_flagged('corrected')},
clean AS (SELECT prev, curr, type, n, month FROM checked WHERE NOT bad)"""

TOTALS = "SELECT 'totals' AS mart, NULL AS month, NULL AS prev, curr, CAST(sum(n) AS BIGINT) AS clicks, NULL::BIGINT AS targets FROM clean GROUP BY curr"
SUMS = f"""
SELECT 'trend' AS mart, month, NULL AS prev, curr, CAST(sum(n) AS BIGINT) AS clicks, NULL::BIGINT AS targets FROM clean GROUP BY month, curr
UNION ALL SELECT 'pairs', month, prev, curr, CAST(sum(n) AS BIGINT), NULL FROM clean WHERE type = 'link' GROUP BY month, prev, curr
UNION ALL SELECT 'out_degree', month, prev, NULL, CAST(sum(n) AS BIGINT), count(DISTINCT curr) FROM clean WHERE type = 'link' GROUP BY month, prev
UNION ALL {TOTALS}"""
BOARDS = """
SELECT 'top_articles_indegree' AS mart, month, NULL AS prev, curr, total_clicks AS clicks, NULL::BIGINT AS targets FROM indegree
UNION ALL SELECT 'top_articles_outdegree', month, prev, NULL, total_clicks_sent, unique_targets FROM outdegree
UNION ALL SELECT 'top_link_pairs', month, prev, curr, total_clicks, NULL FROM pairs"""

ORACLE: dict[str, str] = {
    "edits_update_mart": f"WITH {SILVER}{_rate('silver', '1 hour')}",
    "edits_supervised_mart": f"WITH {SILVER}{_rate('silver', '1 hour')}",
    "edits_delivery_outcomes": OUTCOMES,
    "top_editors_top15": _first_editors(5, 1, 15),
    "top_editors_top15_daily": _first_editors(48 * 60, 12 * 60, 15),
    "upkeep_marts": f"{CORRECTED}{SUMS}",
    "upkeep_boards": f"{CORRECTED},{INDEGREE},{OUTDEGREE},{PAIRS}{BOARDS}",
    "published_boards_after_crash": f"{CLEAN},{INDEGREE},{OUTDEGREE},{PAIRS}{BOARDS}\nUNION ALL {TOTALS}",
    "incremental_load": f"""{CORRECTED}
SELECT 'totals' AS mart, NULL AS month, curr, CAST(sum(n) AS BIGINT) AS clicks FROM clean GROUP BY curr
UNION ALL VALUES ('run 2', NULL, NULL, 0::BIGINT), ('run 3', '1995-03', NULL, 1::BIGINT), ('run 3', '1996-07', NULL, 1::BIGINT)""",
    "dash_trend_top10_threshold": f"""{CLEAN},{TREND},
leaders AS (
  SELECT curr FROM trend WHERE curr NOT IN ('Main_Page', 'Hyphen-minus')
  GROUP BY curr ORDER BY sum(monthly_clicks) DESC, curr LIMIT 10
)
SELECT month, curr, monthly_clicks FROM trend WHERE curr IN (SELECT curr FROM leaders)""",
    "targets_over_months": f"""WITH {CLICKSTREAM},{_flagged('clickstream')}
SELECT prev, count(DISTINCT curr) AS targets, true AS within FROM checked
WHERE NOT bad AND type = 'link' AND month IN ('1994-01', '1994-02', '1994-03', '1995-03', '1996-07') GROUP BY prev""",
    "title_lookup": f"{CLEAN},{TREND}\nSELECT * FROM trend WHERE curr IN ('17', '404', 'no such title')",
    "pair_lookup_both_ways": f"""{CLEAN},
pairs AS (SELECT month, prev, curr, CAST(sum(n) AS BIGINT) AS total_clicks FROM clean WHERE type = 'link' GROUP BY month, prev, curr)
SELECT *, 'from' AS asked FROM pairs WHERE prev = '7' UNION ALL SELECT *, 'to' FROM pairs WHERE curr = '17'""",
}
