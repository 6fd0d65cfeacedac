"""DuckDB SQL twins of ``feedlens.sources.driver`` (the role views).

Each view is a CTE with its dependencies; ``with_views`` prefixes a query body
with exactly the CTEs it references (transitively). This is oracle text for
the correctness gate, run by DuckDB over the driver's parquet views.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2001-07-01 00:00:00'"
RUN = "'driver-run'"

VIEWS: dict[str, str] = {
    "v_events_src": f"""
  SELECT o.o_orderkey AS event_id, c.c_name AS title, c.c_mktsegment AS category_type,
         o.o_orderpriority AS event_category_name,
         CASE WHEN o.o_orderkey % 401 = 3 THEN 'not-a-date' ELSE CAST(o.o_orderdate AS VARCHAR) END AS event_datetime_raw,
         CASE WHEN o.o_orderkey % 1201 = 5 THEN NULL ELSE CAST(o.o_orderdate AS VARCHAR) END AS event_utc_raw,
         CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS date_display
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "v_events": f"""
  SELECT event_id, title, category_type, event_category_name,
         CASE WHEN event_id % 251 = 0 THEN TRY_CAST(event_datetime_raw AS TIMESTAMP) + INTERVAL 2 DAY
              ELSE TRY_CAST(event_datetime_raw AS TIMESTAMP) END AS event_datetime,
         event_datetime_raw, 'UTC' AS event_timezone,
         TRY_CAST(event_utc_raw AS TIMESTAMP) AS event_utc_datetime, date_display,
         {AS_OF} AS first_seen_at, {AS_OF} AS last_seen_at
  FROM v_events_src""",
    "v_li": """
  SELECT l_orderkey, SUM(l_quantity) AS qty, MAX(l_shipdate) AS upd FROM lineitem GROUP BY l_orderkey""",
    "v_market": f"""
  SELECT {RUN} || ':' || CAST(k AS VARCHAR) AS state_id, {RUN} AS run_id, k AS event_id,
         'orders__offset-' || CAST(k - k % 100 AS VARCHAR) || '.json' AS source_file,
         price AS get_in_price,
         CASE WHEN k % 499 = 0 THEN -1 ELSE CAST(qty AS INTEGER) END AS stats_total_quantity,
         upd AS stats_last_updated_at,
         k % 3 = 0 AS forecast_is_available,
         fval AS forecast_value,
         CASE WHEN fval >= 0.5 THEN 'Prices likely to rise' ELSE 'Prices likely to fall' END AS forecast_layover_text,
         CAST(k % 100 AS VARCHAR) || '% confidence' AS forecast_hover_text,
         (price = 0.0 AND o_orderdate < {AS_OF}) AS is_past_with_no_pricing,
         CASE WHEN k % 1000 = 7 THEN 1 ELSE 0 END AS mock_data_point,
         0 AS disable_click_through,
         {AS_OF} AS loaded_at
  FROM (SELECT o.o_orderkey AS k, o.o_orderdate, li.qty, li.upd,
               CASE WHEN o.o_orderkey % 997 = 0 THEN NULL WHEN o.o_orderkey % 6 = 0 THEN 0.0
                    ELSE o.o_totalprice END AS price,
               CASE WHEN o.o_orderkey % 10 = 1 THEN -100.0 WHEN o.o_orderkey % 10 = 2 THEN -1.0
                    ELSE CAST(o.o_orderkey % 100 AS DOUBLE) / 100.0 END AS fval
        FROM orders o LEFT JOIN v_li li ON o.o_orderkey = li.l_orderkey) x""",
    "v_event_venues": """
  SELECT DISTINCT l_orderkey AS event_id, 'venue-' || CAST(l_suppkey AS VARCHAR) AS venue_slug FROM lineitem""",
    "v_venues": f"""
  SELECT 'venue-' || CAST(s.s_suppkey AS VARCHAR) AS venue_slug, s.s_name AS venue_name, n.n_name AS city,
         CAST(NULL AS VARCHAR) AS state, r.r_name AS country, {AS_OF} AS first_seen_at, {AS_OF} AS last_seen_at
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_performers": f"""
  SELECT 'performer-' || CAST(c_custkey AS VARCHAR) AS performer_slug, c_name AS performer_name,
         {AS_OF} AS first_seen_at, {AS_OF} AS last_seen_at FROM customer""",
    "v_event_performers": """
  SELECT o_orderkey AS event_id, 'performer-' || CAST(o_custkey AS VARCHAR) AS performer_slug
  FROM orders WHERE o_orderkey % 700 <> 0""",
    "v_win_base": """
  SELECT o.o_orderkey AS event_id, c.c_mktsegment AS category_type,
         CAST(ROUND(o.o_totalprice * 100.0) AS BIGINT) AS cents,
         CAST(CAST(o.o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS day
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "v_win_daily": """
  SELECT category_type, day, SUM(cents) AS s, COUNT(*) AS n FROM v_win_base GROUP BY category_type, day""",
    "v_win_trail": "\n  UNION ALL".join(
        f"""
  SELECT category_type, day, {d} AS window_days,
         CAST(SUM(s) OVER (PARTITION BY category_type ORDER BY day RANGE BETWEEN {d} PRECEDING AND 1 PRECEDING) AS DOUBLE)
       / CAST(SUM(n) OVER (PARTITION BY category_type ORDER BY day RANGE BETWEEN {d} PRECEDING AND 1 PRECEDING) AS DOUBLE) AS p
  FROM v_win_daily""" for d in (3, 7, 14, 30)),
    "v_windows": f"""
  SELECT {RUN} || ':' || CAST(b.event_id AS VARCHAR) || ':' || CAST(t.window_days AS VARCHAR) AS window_id,
         {RUN} AS run_id, b.event_id, CAST(t.window_days AS INTEGER) AS window_days,
         CASE WHEN b.event_id % 211 = 0 THEN 'flat' WHEN b.cents - t.p > 0 THEN 'up'
              WHEN b.cents - t.p < 0 THEN 'down' ELSE 'flat' END AS direction,
         CASE WHEN t.p IS NULL THEN 0.0
              ELSE ROUND(((100.0 * (b.cents - t.p)) / NULLIF(t.p, 0.0)) * 100.0) / 100.0 END AS percent_change,
         CASE WHEN t.p IS NULL THEN (CASE WHEN b.event_id % 20 = 0 THEN 1.0 ELSE 0.0 END)
              ELSE ROUND(b.cents - t.p) / 100.0 END AS raw_change,
         t.p IS NULL AS insufficient_data
  FROM v_win_base b JOIN v_win_trail t ON b.category_type = t.category_type AND b.day = t.day""",
    "v_pages_agg": f"""
  SELECT o_orderkey - o_orderkey % 100 AS page_offset, CAST(COUNT(*) AS INTEGER) AS n,
         COUNT(*) FILTER (WHERE o_orderdate >= {AS_OF}) AS upcoming
  FROM orders GROUP BY o_orderkey - o_orderkey % 100""",
    "v_pages_tot": """
  SELECT COUNT(*) AS total, MAX(o_orderkey - o_orderkey % 100) AS last_offset,
         CAST(MIN(o_orderdate) AS DATE) AS dmin, CAST(MAX(o_orderdate) AS DATE) AS dmax FROM orders""",
    "v_pages": f"""
  SELECT substr(sha256(src), 1, 16) AS file_id, {RUN} AS run_id, src AS source_file,
         CAST(page_offset AS BIGINT) AS "offset",
         CASE WHEN pg % 50 = 49 THEN 'error' ELSE 'success' END AS feed_status,
         CASE WHEN pg % 60 = 59 THEN NULL ELSE total END AS total_db_matches,
         n AS current_page_results, page_offset < last_offset AS has_more, 100 AS limit_per_page,
         CAST(NULL AS VARCHAR) AS tab_requested, dmin AS date_filter_start, dmax AS date_filter_end,
         upcoming AS upcoming_count, n - upcoming AS past_count, CAST(n AS BIGINT) AS total_count,
         {AS_OF} AS loaded_at
  FROM (SELECT a.*, a.page_offset // 100 AS pg,
               'orders__offset-' || CAST(a.page_offset AS VARCHAR) || '.json' AS src FROM v_pages_agg a) x
  CROSS JOIN v_pages_tot
  WHERE pg % 37 <> 36""",
    "v_raw": f"""
  SELECT concat_ws(':', substr(sha256(src), 1, 16), CAST(eid AS VARCHAR)) AS raw_id, {RUN} AS run_id,
         src AS source_file, k - k % 100 AS source_offset, eid AS event_id, {AS_OF} AS loaded_at
  FROM (SELECT o_orderkey AS k,
               'orders__offset-' || CAST(o_orderkey - o_orderkey % 100 AS VARCHAR) || '.json' AS src,
               CASE WHEN o_orderkey % 1999 = 11 THEN NULL ELSE o_orderkey END AS eid
        FROM orders WHERE o_orderkey % 1301 <> 0) x""",
}

_NAME_RE = re.compile(r"\b(v_[a-z0-9_]+)\b")


def _refs(text: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME_RE.findall(text)) if n in VIEWS]


def add_views(extra: dict[str, str]) -> None:
    VIEWS.update(extra)


def with_views(body: str, extra: dict[str, str] | None = None, ctes: str = "") -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first; ``ctes`` is
    extra CTE text ("name AS (...), ...") placed after the views it uses."""
    views = dict(VIEWS)
    views.update(extra or {})
    order: list[str] = []

    def visit(name: str, stack=()):
        if name in order:
            return
        for dep in [n for n in dict.fromkeys(_NAME_RE.findall(views[name])) if n in views and n != name]:
            if dep not in stack:
                visit(dep, stack + (name,))
        order.append(name)

    for n in [n for n in dict.fromkeys(_NAME_RE.findall(ctes + " " + body)) if n in views]:
        visit(n)
    parts = [f"{n} AS ({views[n]}\n)" for n in order]
    if ctes.strip():
        parts.append(ctes.strip())
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
