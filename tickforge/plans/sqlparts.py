"""DuckDB oracle building blocks (the same fixtures as tickforge.sources.fixtures,
written as SQL CTEs over the pre-registered tables)."""

from __future__ import annotations

from tickforge.sources.fixtures import PROXIES


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def rounded(inner: str, dbl: list[str], digits: int = 20, order: str | None = None) -> str:
    """Wrap a query so the listed double columns are rounded (float sums differ
    between engines in the last bits)."""
    if not dbl:
        return inner
    k = f"{2 ** digits}.0"
    rep = ", ".join(f"CASE WHEN round({q(c)} * {k}) = 0 THEN 0.0 ELSE round({q(c)} * {k}) / {k} END AS {q(c)}"
                    for c in dbl)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) AS rq"


def in_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


PROXIES_SQL = in_list(PROXIES)

BARS_DAILY = """
ticks AS (
  SELECT p.p_brand AS ticker, CAST(CAST(l.l_shipdate AS DATE) AS TIMESTAMP) AS bt,
         l.l_extendedprice / l.l_quantity AS px, l.l_quantity AS qty,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
bars AS (
  SELECT ticker, bt AS t,
         first(px ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, px) AS o,
         max(px) AS h, min(px) AS l,
         last(px ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, px) AS c,
         CAST(sum(qty) AS DOUBLE) AS v,
         coalesce(sum(px * qty) / nullif(sum(qty), 0), 0.0) AS vw,
         CAST(count(*) AS BIGINT) AS n
  FROM ticks GROUP BY ticker, bt)"""

BARS_HOURLY = """
ticks AS (
  SELECT event_type AS ticker, date_trunc('hour', ts) AS bt, value AS px, 1.0 AS qty, ts, event_id
  FROM events),
bars AS (
  SELECT ticker, bt AS t,
         first(px ORDER BY ts, event_id, px) AS o, max(px) AS h, min(px) AS l,
         last(px ORDER BY ts, event_id, px) AS c,
         CAST(sum(qty) AS DOUBLE) AS v,
         coalesce(sum(px * qty) / nullif(sum(qty), 0), 0.0) AS vw,
         CAST(count(*) AS BIGINT) AS n
  FROM ticks GROUP BY ticker, bt)"""

NEWS = """
news AS (
  SELECT 'Brand#' || CAST(doc_id % 25 + 1 AS VARCHAR) AS search_ticker,
         strftime(CAST(DATE '1995-01-02' + CAST((doc_id * 37) % 2499 AS INTEGER) AS TIMESTAMP),
                  '%Y-%m-%dT%H:%M:%SZ') AS published_utc,
         substring(text, 1, 60) AS title, text AS description,
         [lang, source] AS keywords, doc_id AS id
  FROM documents)"""


def proxy_pivot_sql(src: str = "bars", fields=("o", "h", "l", "c", "v", "vw", "n")) -> str:
    """Wide proxy table by t (conditional aggregation; (ticker, t) is unique)."""
    from tickforge.sources.fixtures import PROXIES as P
    cols = ", ".join(f"max(CASE WHEN ticker = '{p}' THEN {f} END) AS {q(p + '_' + f)}"
                     for p in P for f in fields)
    return f"SELECT t, {cols} FROM {src} WHERE ticker IN {PROXIES_SQL} GROUP BY t"


def proxy_cols(fields=("o", "h", "l", "c", "v", "vw", "n")) -> list[str]:
    from tickforge.sources.fixtures import PROXIES as P
    return [f"{p}_{f}" for p in P for f in fields]


NEWS_DAILY = NEWS + """,
news_daily AS (
  SELECT search_ticker AS ticker,
         CAST(CAST(substr(published_utc, 1, 10) AS DATE) AS TIMESTAMP) AS t,
         replace(string_agg(concat_ws(' ', description, coalesce(array_to_string(keywords, ' '), ''), title),
                            ' ' ORDER BY CAST(replace(published_utc, 'Z', '') AS TIMESTAMP), id),
                 chr(10), ' ') AS aggregated_text
  FROM news GROUP BY 1, 2)"""
