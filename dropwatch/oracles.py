"""DuckDB SQL for each registered query, written from the definitions rather than from the
Spark plans: grids are cross joined, histories self-joined, levels aggregated one by one."""

from __future__ import annotations

from dropwatch.config import (
    CLICK_LIST,
    COUNT_COLS,
    ID_COLS,
    LAGS,
    LEVEL_COLS,
    LEVELS,
    MEDIAN_COLS,
)
from dropwatch.queries import ALERT, HOURLY_MIN, RUN_DATE

FIRST_DATE = "2024-01-18"
TRAFFIC = f"""traffic AS (
  SELECT e.event_id, r.r_name AS country, c.c_mktsegment AS website_name,
         e.event_type AS action, 'zone_' || (e.k % 3) AS zone, e.date,
         CASE WHEN e.event_type = 'error' OR
                   (r.r_name = 'ASIA' AND e.date = '{RUN_DATE}' AND e.k >= 5)
              THEN 0 ELSE 1 END AS clicks,
         e.user_id % 40 AS master_user_group_id,
         e.user_id || '|' || e.k AS ip_address_user_agent,
         n.n_name AS city_code, c.c_name AS company_name, 'd' || e.k AS domain_name
  FROM (SELECT *, strftime(ts + INTERVAL 10 DAY, '%Y-%m-%d') AS date,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events) e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

TRAFFIC_LONG = """traffic AS (
  SELECT r.r_name AS country, c.c_mktsegment AS website_name, l_returnflag AS action,
         l_linestatus AS zone, strftime(l_shipdate, '%Y-%m-%d') AS date,
         CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS clicks,
         o_custkey AS master_user_group_id, l_suppkey AS ip_address_user_agent,
         n.n_name AS city_code, c.c_name AS company_name, l_partkey AS domain_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer c ON o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

FULLER_RAW = TRAFFIC.replace("traffic AS (", "raw AS (", 1)
FULLER = f"""traffic AS (
  SELECT * REPLACE ('SITE' AS website_name, 'visit' AS action, 'zone_' || (event_id % 2) AS zone,
    CASE WHEN date = '{RUN_DATE}' AND event_id % 20 <> 0 AND country IN ('EUROPE', 'AFRICA')
         THEN 0 ELSE 1 END AS clicks) FROM raw)"""

LOOKBACK = f"""lookback AS (
  SELECT * FROM traffic WHERE date BETWEEN '{FIRST_DATE}' AND '{RUN_DATE}' AND country <> '***')"""

SPINE = f"""spine AS (
  SELECT strftime(d, '%Y-%m-%d') AS date
  FROM generate_series(DATE '{FIRST_DATE}', DATE '{RUN_DATE}', INTERVAL 1 DAY) s(d))"""

USAGE_FIRST, USAGE_END = "2023-02-01", "2024-02-01"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _list(columns, prefix="") -> str:
    return ", ".join(f"{prefix}{c}" for c in columns)


def _same(keys, a, b) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


def _distinct_counts() -> str:
    return ", ".join(f"count(DISTINCT {c}) AS {n}" for c, n in zip(ID_COLS, COUNT_COLS))


def _medians(columns=COUNT_COLS) -> str:
    return ", ".join(f"quantile_disc({c}, 0.5) AS median_{c}" for c in columns)


def _counts(keys, source, sums=True) -> str:
    clicks = "CAST(sum(clicks) AS BIGINT) AS clicks, " if sums else ""
    by = f"{_list(keys)}, date"
    return (
        f"SELECT {by}, {clicks}{_distinct_counts()} FROM {source} WHERE clicks = 1 GROUP BY {by}"
    )


def _usage(keys, first=USAGE_FIRST, end=USAGE_END) -> str:
    source = f"(SELECT * FROM traffic WHERE date >= '{first}' AND date < '{end}')"
    return (
        f"SELECT {_list(keys)}, {_medians()} FROM ({_counts(keys, source)}) GROUP BY {_list(keys)}"
    )


def _observed(keys) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return _counts(keys, f"(SELECT * FROM lookback WHERE {present})")


def _dense(keys, groups="SELECT DISTINCT {keys} FROM lookback") -> str:
    """Grid of groups and dates, left joined with the clicks per day (and audience counts)."""
    groups = groups.format(keys=_list(keys))
    counts = ", ".join(f"coalesce(d.{c}, 0) AS {c}" for c in ("clicks", *COUNT_COLS))
    return (
        f"SELECT {_list(keys, 'g.')}, s.date, {counts} FROM ({groups}) g CROSS JOIN spine s "
        f"LEFT JOIN ({_counts(keys, 'lookback')}) d ON d.date = s.date AND {_same(keys, 'd', 'g')}"
    )


def _dense_active(keys) -> str:
    return _dense(keys, "SELECT DISTINCT {keys} FROM lookback WHERE clicks = 1")


def _lags(keys, source) -> str:
    over = f"OVER (PARTITION BY {_list(keys)} ORDER BY date)"
    lags = ", ".join(f"lag(clicks, {k}) {over} AS prev_clicks_{k}days" for k in LAGS)
    return f"SELECT *, {lags} FROM ({source})"


def _estimates(keys, source) -> str:
    def mean(lags):
        return "(" + " + ".join(f"prev_clicks_{k}days" for k in lags) + ") / 3.0"

    return (
        f"SELECT *, CASE WHEN estimate > 0 THEN clicks / estimate END AS ratio FROM (SELECT *, "
        f"CAST({mean((1, 2, 3))} AS DOUBLE) AS avg_prev_3days, "
        f"CAST({mean((7, 14, 21))} AS DOUBLE) AS estimate FROM ({_lags(keys, source)}))"
    )


def _judged(keys, mode) -> str:
    """Baseline rows with the usage reference."""
    series = _observed(keys) if mode == "observed" else _dense_active(keys)
    same = (
        " AND ".join(f"b.{k} = u.{k}" for k in keys)
        if mode == "observed"
        else _same(keys, "b", "u")
    )
    return (
        f"SELECT b.*, {_list(MEDIAN_COLS, 'u.')} FROM ({_estimates(keys, series)}) b "
        f"LEFT JOIN ({_usage(keys)}) u ON {same}"
    )


IS_DROP = (
    f"estimate > {ALERT.min_clicks} AND ratio < {ALERT.ratio} "
    f"AND median_count_ip_address_user_agent > {ALERT.min_ipua} "
    f"AND median_count_domain_name > {ALERT.min_domain}"
)

DAILY_CTES = (TRAFFIC, LOOKBACK, SPINE)


def _history(keys, mode) -> str:
    judged = _judged(keys, mode)
    return (
        f"SELECT {_list(keys, 'h.')}, h.date, h.clicks FROM ({judged}) h JOIN "
        f"(SELECT {_list(keys)} FROM ({judged}) WHERE date = '{RUN_DATE}' AND {IS_DROP}) a "
        f"ON {_same(keys, 'h', 'a')} WHERE h.date >= '2024-02-01'"
    )


def _click_list(keys, mode) -> str:
    return (
        f"SELECT {_list(keys)}, '{RUN_DATE}' AS run_date, "
        f"string_agg(CAST(clicks AS VARCHAR), ', ' ORDER BY date DESC) AS {CLICK_LIST} "
        f"FROM ({_history(keys, mode)}) GROUP BY {_list(keys)}"
    )


def _padded(keys) -> str:
    return ", ".join(c if c in keys else f"NULL::VARCHAR AS {c}" for c in LEVEL_COLS)


def _all_click_lists(mode) -> str:
    return " UNION ALL ".join(
        f"SELECT {depth} AS level, '{'_'.join(keys)}' AS source, run_date, {_padded(keys)}, "
        f"{CLICK_LIST} FROM ({_click_list(keys, mode)})"
        for depth, keys in enumerate(LEVELS.values(), start=1)
    )


def _all_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT {depth} AS level, {_padded(keys)}, date, clicks, {_list(COUNT_COLS)} "
        f"FROM ({_counts(keys, 'traffic')})"
        for depth, keys in enumerate(LEVELS.values(), start=1)
    )


def _round(columns, source, doubles) -> str:
    shown = [f"round({c}, 6) AS {c}" if c in doubles else c for c in columns]
    return f"SELECT {', '.join(shown)} FROM ({source})"


ESTIMATES = ("avg_prev_3days", "estimate", "ratio")
SHARES = ("daily_traffic_percentage", "daily_cumulative_percentage")


def _ranking(keys, series) -> str:
    total = "sum(clicks) OVER (PARTITION BY date)"
    by_clicks = "OVER (PARTITION BY date ORDER BY clicks DESC"
    ranked = (
        f"SELECT *, CAST({total} AS BIGINT) AS daily_total_clicks, "
        f"CAST(clicks AS DOUBLE) / nullif({total}, 0) AS daily_traffic_percentage, "
        f"CAST(sum(clicks) {by_clicks} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
        f"AS DOUBLE) / nullif({total}, 0) AS daily_cumulative_percentage, "
        f"CAST(rank() {by_clicks}) AS INTEGER) AS daily_rank FROM ({_estimates(keys, series)})"
    )
    columns = [
        *keys,
        "date",
        "clicks",
        *COUNT_COLS,
        *[f"prev_clicks_{k}days" for k in LAGS],
        *ESTIMATES,
        "daily_total_clicks",
        *SHARES,
        "daily_rank",
    ]
    return _round(columns, ranked, (*ESTIMATES, *SHARES))


def _estimate_query(keys) -> str:
    columns = [*keys, "date", "clicks", *ESTIMATES]
    return _with(*DAILY_CTES) + _round(columns, _estimates(keys, _observed(keys)), ESTIMATES)


# --- backfills ----------------------------------------------------------------------------


def _month_shift(date: str, months: str) -> str:
    return f"strftime(CAST(substr({date}, 1, 7) || '-01' AS DATE) + {months}, '%Y-%m')"


def _usage_of_months(counts) -> str:
    """Medians per run month and group over the days of the twelve months before it."""
    months = (
        "SELECT DISTINCT strftime(CAST(substr(date, 1, 7) || '-01' AS DATE) + "
        "INTERVAL 1 MONTH, '%Y-%m') AS run_month FROM daily"
    )
    spine = (
        f"SELECT strftime(m, '%Y-%m') AS run_month FROM (SELECT min(run_month) AS a, "
        f"max(run_month) AS b FROM ({months})), "
        f"generate_series(CAST(a || '-01' AS DATE), CAST(b || '-01' AS DATE), INTERVAL 1 MONTH) s(m)"
    )
    keys = ("level", *LEVEL_COLS)
    return (
        f"SELECT run_month, {_list(keys)}, {_medians(counts)} FROM daily JOIN ({spine}) r "
        f"ON substr(date, 1, 7) < r.run_month AND substr(date, 1, 7) >= "
        f"{_month_shift('r.run_month', 'INTERVAL (-12) MONTH')} GROUP BY run_month, {_list(keys)}"
    )


FOLDERED = """foldered AS (
  SELECT *, CASE WHEN CAST(substr(date, 9, 2) AS INTEGER) <= 2 AND master_user_group_id % 5 = 0
    THEN strftime(CAST(date AS DATE) - INTERVAL 1 MONTH, '%Y-%m') ELSE substr(date, 1, 7) END AS folder
  FROM traffic WHERE clicks = 1), looked AS (
  SELECT run_month, foldered.* FROM foldered JOIN (
    SELECT strftime(m, '%Y-%m') AS run_month FROM (
      SELECT CAST(min(folder) || '-01' AS DATE) + INTERVAL 1 MONTH AS a,
        CAST(max(folder) || '-01' AS DATE) + INTERVAL 1 MONTH AS b FROM foldered),
      generate_series(a, b, INTERVAL 1 MONTH) s(m)) r
  ON folder < r.run_month AND folder >= strftime(CAST(r.run_month || '-01' AS DATE) - INTERVAL 12 MONTH, '%Y-%m'))"""


def _usage_of_folders() -> str:
    """Every run month counts all rows of its twelve folders anew."""
    levels = " UNION ALL ".join(
        f"SELECT run_month, {depth} AS level, {_padded(keys)}, date, {_list(COUNT_COLS)} "
        f"FROM ({_counts(('run_month', *keys), 'looked')})"
        for depth, keys in enumerate(LEVELS.values(), start=1)
    )
    keys = _list(("run_month", "level", *LEVEL_COLS))
    return f"SELECT {keys}, {_medians(COUNT_COLS)} FROM ({levels}) GROUP BY {keys}"


def _daily_backfill(mode) -> str:
    """Each run date is judged on its own window: runs x groups x dates are spelled out."""
    keys = ("level", *LEVEL_COLS)
    runs = (
        "runs AS (SELECT strftime(d, '%Y-%m-%d') AS run_date, "
        "strftime(d - INTERVAL 21 DAY, '%Y-%m-%d') AS first_date FROM "
        "(SELECT min(date) AS a, max(date) AS b FROM daily), "
        "generate_series(CAST(a AS DATE), CAST(b AS DATE), INTERVAL 1 DAY) s(d))"
    )
    known = "known AS (SELECT * FROM daily WHERE country <> '***')"
    if mode == "observed":
        present = " AND ".join(
            f"({c} IS NOT NULL OR level < {i})" for i, c in enumerate(LEVEL_COLS, start=1)
        )
        series = (
            f"series AS (SELECT r.run_date, {_list(keys, 'd.')}, d.date, d.clicks FROM known d "
            f"JOIN runs r ON d.date BETWEEN r.first_date AND r.run_date WHERE {present})"
        )
    else:
        series = (
            f"series AS (SELECT g.run_date, {_list(keys, 'g.')}, g.date, "
            f"coalesce(d.clicks, 0) AS clicks FROM (SELECT DISTINCT r.run_date, r.first_date, "
            f"{_list(keys, 'd.')}, strftime(t, '%Y-%m-%d') AS date FROM known d JOIN runs r "
            f"ON d.date BETWEEN r.first_date AND r.run_date, "
            f"generate_series(CAST(r.first_date AS DATE), CAST(r.run_date AS DATE), "
            f"INTERVAL 1 DAY) s(t)) g LEFT JOIN known d ON d.date = g.date AND "
            f"{_same(keys, 'd', 'g')})"
        )
    over = f"(PARTITION BY run_date, {_list(keys)} ORDER BY date)"
    estimate = " + ".join(f"lag(clicks, {k}) OVER {over}" for k in (7, 14, 21))
    est = (
        f"est AS (SELECT *, CASE WHEN estimate > 0 THEN clicks / estimate END AS ratio FROM "
        f"(SELECT *, CAST(({estimate}) / 3.0 AS DOUBLE) AS estimate FROM series))"
    )
    usage = f"usage AS ({_usage_of_months(COUNT_COLS)})"
    hits = (
        f"hits AS (SELECT e.* FROM est e LEFT JOIN usage u ON u.run_month = "
        f"substr(e.run_date, 1, 7) AND {_same(keys, 'e', 'u')} "
        f"WHERE e.date = e.run_date AND {IS_DROP})"
    )
    lists = (
        f"SELECT h.run_date, {_list(keys, 'h.')}, h.clicks, round(h.estimate, 6) AS estimate, "
        f"round(h.ratio, 6) AS ratio, string_agg(CAST(s.clicks AS VARCHAR), ', ' "
        f"ORDER BY s.date DESC) AS {CLICK_LIST} FROM hits h JOIN series s "
        f"ON s.run_date = h.run_date AND {_same(keys, 's', 'h')} AND s.date >= "
        f"strftime(CAST(h.run_date AS DATE) - INTERVAL 7 DAY, '%Y-%m-%d') "
        f"GROUP BY h.run_date, {_list(keys, 'h.')}, h.clicks, h.estimate, h.ratio"
    )
    daily = f"daily AS ({_all_counts()})"
    return _with(TRAFFIC, daily, runs, known, series, est, usage, hits) + lists


# --- hourly -------------------------------------------------------------------------------

_HOUR = "'%Y-%m-%d %H:00'"
HOURLY_LOG = (
    "log AS (SELECT 'srv-' || (user_id % 5) AS ct_flume_host, "
    "CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ct_datetime, "
    f"strftime(ts + INTERVAL 5 MINUTE, {_HOUR}) AS dir_hour FROM events)"
)

_EVENT_HOUR = f"strftime(make_timestamp_ms(TRY_CAST(ct_datetime AS BIGINT)), {_HOUR})"
HOURS = (
    f"hours AS (SELECT dir_hour, ct_flume_host AS server, {_EVENT_HOUR} AS date_hour, "
    "count(*) AS traffic FROM log GROUP BY ALL)"
)


def _plus_hour(hour: str, hours: int = 1) -> str:
    return f"strftime(CAST({hour} || ':00' AS TIMESTAMP) + INTERVAL ({hours}) HOUR, {_HOUR})"


def _complete(hour: str, source: str) -> str:
    return (
        f"SELECT DISTINCT {hour} AS run_hour FROM {source} WHERE {_plus_hour(hour, -1)} IN "
        f"(SELECT {hour} FROM {source})"
    )


COMPARE = (
    "compared AS (SELECT run_hour, server, coalesce(date_hour, run_hour) AS date_hour, "
    "coalesce(traffic, 0) AS traffic, coalesce(traffic_prev1h, 0) AS traffic_prev1h FROM "
    f"(SELECT {_plus_hour('dir_hour')} AS run_hour, server, traffic AS traffic_prev1h FROM hours) p "
    "FULL JOIN (SELECT dir_hour AS run_hour, server, date_hour, traffic FROM hours) c "
    f"USING (run_hour, server) WHERE run_hour IN ({_complete('dir_hour', 'hours')}))"
)
LOW = (
    f"low AS (SELECT * FROM compared WHERE traffic < {HOURLY_MIN} "
    f"AND traffic_prev1h >= {HOURLY_MIN})"
)

# Run hours from two before the log's first hour to two after its last.
MISSING = (
    "present AS (SELECT DISTINCT dir_hour FROM log), "
    f"runs AS (SELECT strftime(h, {_HOUR}) AS run_hour FROM "
    "(SELECT min(dir_hour) AS a, max(dir_hour) AS b FROM log), "
    "generate_series(CAST(a || ':00' AS TIMESTAMP) - INTERVAL 2 HOUR, "
    "CAST(b || ':00' AS TIMESTAMP) + INTERVAL 2 HOUR, INTERVAL 1 HOUR) s(h)), "
    "missing AS (SELECT run_hour, missing_hour FROM (SELECT run_hour, "
    "CASE WHEN run_hour NOT IN (SELECT dir_hour FROM present) THEN run_hour "
    f"WHEN {_plus_hour('run_hour', -1)} NOT IN (SELECT dir_hour FROM present) "
    f"THEN {_plus_hour('run_hour', -1)} END AS missing_hour FROM runs) "
    "WHERE missing_hour IS NOT NULL)"
)

EVENT_TIME_LOW = (
    f"SELECT run_hour, server, run_hour AS date_hour, "
    "coalesce(traffic, 0) AS traffic, coalesce(traffic_prev1h, 0) AS traffic_prev1h FROM "
    f"(SELECT {_plus_hour('date_hour')} AS run_hour, server, traffic AS traffic_prev1h FROM counted) p "
    "FULL JOIN (SELECT date_hour AS run_hour, server, traffic FROM counted) c "
    f"USING (run_hour, server) WHERE run_hour IN ({_complete('date_hour', 'counted')}) "
    f"AND coalesce(traffic, 0) < {HOURLY_MIN} AND coalesce(traffic_prev1h, 0) >= {HOURLY_MIN}"
)
COUNTED = (
    f"counted AS (SELECT server, date_hour, CAST(sum(traffic) AS BIGINT) AS traffic FROM hours "
    "WHERE date_hour IS NOT NULL GROUP BY ALL)"
)


HOURLY_REPORT = (
    _with(HOURLY_LOG, HOURS, COMPARE, LOW, MISSING)
    + "SELECT *, 'low traffic' AS report, NULL::VARCHAR AS missing_hour FROM low UNION ALL "
    "SELECT run_hour, NULL, NULL, NULL, NULL, 'missing hour', missing_hour FROM missing"
)


# --- messages -----------------------------------------------------------------------------


def _shown(columns) -> str:
    return " || ' | ' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in columns)


def _body(head, line, order) -> str:
    lines = "".join(f"'{h}' || chr(10) || " for h in head)
    return f"{lines}string_agg({line}, chr(10) ORDER BY {order}) AS body"


def _alert_message() -> str:
    columns = ("run_date", *LEVEL_COLS, CLICK_LIST)
    head = [
        "Groups whose clicks fell far below the same weekday of the three weeks before.",
        f"Listed if more than {ALERT.min_clicks:g} clicks were expected, less than",
        f"{ALERT.ratio:g} of them came, and a usual day has more than",
        f"{ALERT.min_ipua:g} visitors and {ALERT.min_domain:g} domains.",
        *[f"One line per {' / '.join(keys)}" for keys in LEVELS.values()],
        " | ".join(columns),
    ]
    order = ", ".join(f"{c} NULLS FIRST" for c in LEVEL_COLS)
    return (
        _with(*DAILY_CTES)
        + f"SELECT run_date, 1 AS part, 'Daily traffic alert ' || run_date AS subject, "
        f"{_body(head, _shown(columns), order)} FROM ({_all_click_lists('calendar')}) "
        "GROUP BY run_date"
    )


def _hourly_message() -> str:
    columns = ("server", "date_hour", "traffic", "traffic_prev1h")
    head = [
        f"Servers with less than {HOURLY_MIN} records this hour and more the hour before.",
        " | ".join(columns),
    ]
    order = "traffic, traffic_prev1h DESC, server NULLS FIRST, date_hour NULLS FIRST"
    return (
        _with(HOURLY_LOG, HOURS, COMPARE, LOW)
        + f"SELECT run_hour, 1 AS part, 'Hourly traffic alert ' || run_hour || ': low traffic' "
        f"AS subject, {_body(head, _shown(columns), order)} FROM low GROUP BY run_hour"
    )


def oracles() -> dict[str, str]:
    country, website, action, zone = LEVELS.values()
    base, daily = _with(TRAFFIC), _with(*DAILY_CTES)
    total = f"SELECT date, sum(clicks) AS total FROM ({_observed(action)}) GROUP BY date"
    sql = {
        "scan_trailing_year": _with(TRAFFIC_LONG)
        + "SELECT * FROM traffic WHERE date >= '1999-01-01' AND date < '2000-01-01'",
        "scan_lookback_window": base
        + f"SELECT * FROM traffic WHERE date BETWEEN '{FIRST_DATE}' AND '{RUN_DATE}'",
        "tsv_hourly_log": _with(HOURLY_LOG) + "SELECT * FROM log",
        "usage_reference_roundtrip": base + _usage(website),
        "alert_csv_roundtrip": daily
        + f"SELECT run_date, {_list(LEVEL_COLS)}, {CLICK_LIST}, source "
        f"FROM ({_all_click_lists('calendar')})",
        "date_spine": base
        + "SELECT strftime(d, '%Y-%m-%d') AS date, "
        "strftime(d - INTERVAL 21 DAY, '%Y-%m-%d') AS lookback_start FROM "
        "(SELECT min(date) AS a, max(date) AS b FROM traffic), "
        "generate_series(CAST(a AS DATE), CAST(b AS DATE), INTERVAL 1 DAY) s(d)",
        "month_spine": _with(TRAFFIC_LONG)
        + "SELECT strftime(m, '%Y-%m') AS month, "
        "strftime(m - INTERVAL 12 MONTH, '%Y-%m') AS reference_start, "
        "strftime(m - INTERVAL 1 MONTH, '%Y-%m') AS reference_end FROM "
        "(SELECT min(date) AS a, max(date) AS b FROM traffic), "
        "generate_series(date_trunc('month', CAST(a AS DATE)), "
        "date_trunc('month', CAST(b AS DATE)), INTERVAL 1 MONTH) s(m)",
        "filter_clicks": base + "SELECT * FROM traffic WHERE clicks = 1",
        "filter_sentinel": base
        + "SELECT * FROM (SELECT * REPLACE (CASE WHEN action = 'view' THEN '***' "
        "WHEN action <> 'signup' THEN country END AS country) FROM traffic) "
        "WHERE country <> '***'",
        "distinct_groups": daily + f"SELECT DISTINCT {_list(zone)} FROM lookback",
        "group_date_grid": daily
        + f"SELECT {_list(zone)}, date FROM (SELECT DISTINCT {_list(zone)} FROM lookback) "
        "CROSS JOIN spine",
        "densified_clicks": daily + f"SELECT {_list(zone)}, date, clicks FROM ({_dense(zone)})",
        "daily_usage": base + _counts(zone, "traffic", sums=False),
        "daily_clicks": base + _counts(website, "traffic"),
        "multi_granularity_clicks": base + _all_counts(),
        "daily_total": daily
        + "SELECT date, CAST(sum(clicks) AS BIGINT) AS daily_total_clicks "
        f"FROM ({_observed(website)}) GROUP BY date",
        "daily_share": daily
        + f"SELECT {_list(action, 'd.')}, d.date, d.clicks, CAST(t.total AS BIGINT) AS "
        "daily_total_clicks, round(CAST(d.clicks AS DOUBLE) / t.total, 6) AS "
        f"daily_traffic_percentage FROM ({_observed(action)}) d LEFT JOIN ({total}) t "
        "ON d.date = t.date",
        "daily_ranking": daily + _ranking(website, _observed(website)),
        "daily_ranking_calendar": daily + _ranking(zone, _dense_active(zone)),
        "clicks_lag": daily
        + f"SELECT * EXCLUDE ({_list(COUNT_COLS)}) FROM ({_lags(website, _observed(website))})",
        "clicks_lag_calendar": daily
        + f"SELECT * EXCLUDE ({_list(COUNT_COLS)}) FROM ({_lags(action, _dense(action))})",
        "clicks_estimate": _estimate_query(website),
        "clicks_estimate_zone": _estimate_query(zone),
        "usage_reference_long": _with(TRAFFIC_LONG) + _usage(zone, "1999-01-01", "2000-01-01"),
        "usage_reference_backfill": _with(TRAFFIC_LONG, f"daily AS ({_all_counts()})")
        + _usage_of_months(COUNT_COLS),
        "usage_reference_folders": _with(TRAFFIC_LONG, FOLDERED) + _usage_of_folders(),
        "clicks_with_usage": daily
        + _round(
            [*website, "date", "clicks", "estimate", "ratio", *MEDIAN_COLS],
            _judged(website, "observed"),
            ESTIMATES,
        ),
        "daily_alert_keys": daily
        + f"SELECT {_list(website)}, '2024-02-01' AS date_7_days_ahead, date AS alert_date "
        f"FROM ({_judged(website, 'observed')}) WHERE date = '{RUN_DATE}' AND {IS_DROP}",
        "alert_history": daily + _history(website, "calendar"),
        "alert_history_ordered": daily
        + f"SELECT {_list(action)}, date, clicks, CAST(row_number() OVER "
        f"(PARTITION BY {_list(action)} ORDER BY date DESC) AS INTEGER) AS rank "
        f"FROM ({_history(action, 'calendar')})",
        "alert_click_list": daily + _click_list(zone, "calendar"),
        "daily_digest": daily
        + f"SELECT run_date, {_list(LEVEL_COLS)}, {CLICK_LIST} "
        f"FROM ({_all_click_lists('calendar')})",
        "daily_digest_observed": daily
        + f"SELECT run_date, {_list(LEVEL_COLS)}, {CLICK_LIST} "
        f"FROM ({_all_click_lists('observed')})",
        "alert_counts": daily
        + f"SELECT run_date, level, count(*) AS alerts FROM ({_all_click_lists('calendar')}) "
        "GROUP BY run_date, level",
        "alert_message": _alert_message(),
        "daily_alerts_backfill": _daily_backfill("observed"),
        "daily_alerts_backfill_calendar": _daily_backfill("calendar"),
        "hourly_traffic": _with(HOURLY_LOG, HOURS) + "SELECT * FROM hours",
        "hourly_compare": _with(HOURLY_LOG, HOURS, COMPARE) + "SELECT * FROM compared",
        "hourly_low_traffic": _with(HOURLY_LOG, HOURS, COMPARE, LOW) + "SELECT * FROM low",
        "hourly_low_traffic_event_time": _with(HOURLY_LOG, HOURS, COUNTED) + EVENT_TIME_LOW,
        "missing_hours": _with(HOURLY_LOG, MISSING) + "SELECT * FROM missing",
        "missing_hours_listed": _with(HOURLY_LOG, MISSING) + "SELECT * FROM missing",
        "missing_hour_message": _with(HOURLY_LOG, MISSING)
        + "SELECT run_hour, 1 AS part, 'Hourly traffic alert ' || run_hour || ': missing hour' "
        "AS subject, 'No data for hour ' || missing_hour AS body FROM missing",
        "hourly_alert_message": _hourly_message(),
        "hourly_low_traffic_backfill": HOURLY_REPORT,
        "hourly_backfill_stored": HOURLY_REPORT,
        "daily_alerts_observed_fuller": _with(FULLER_RAW, FULLER, *DAILY_CTES[1:])
        + _history(LEVELS["zone"], "observed"),
    }
    for level, keys in LEVELS.items():
        sql[f"usage_reference_{level}"] = base + _usage(keys)
        for mode in ("observed", "calendar"):
            sql[f"daily_alerts_{mode}_{level}"] = daily + _history(keys, mode)
    return sql
