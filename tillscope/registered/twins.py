"""SQL twins of the registered queries, for an independent engine on the same tables.

They state the results directly: range conditions where the library joins on cells, and
arithmetic on keys where it parses text.
"""

from __future__ import annotations

SPACE = 4294967296


def _spread(key: str, offset: int = 0) -> str:
    return f"((({key} % {SPACE}) * 1640531527 + {offset}) % {SPACE})"


def _dotted(n: str) -> str:
    return (
        f"(({n}) // 16777216 || '.' || ({n}) // 65536 % 256 || '.' || ({n}) // 256 % 256"
        f" || '.' || ({n}) % 256)"
    )


def _order_address(key: str) -> str:
    n = _spread(key)
    return (
        f"(CASE WHEN {key} % 4 = 3 THEN 3405803783 WHEN {key} % 11 = 0 THEN {n} // 65536 * 65536"
        f" WHEN {key} % 11 = 1 THEN {n} // 65536 * 65536 + 65535 ELSE {n} END)"
    )


_SIZE = "(CAST(1 AS BIGINT) << (32 - p))"

_SALES = f"""
sales AS (
  SELECT 'product' || l_partkey AS name, l_extendedprice AS price, l_shipdate AS ts,
         CASE WHEN l_partkey % 97 <> 13 THEN 'category' || (l_suppkey % 25) END AS category,
         {_dotted('n')} AS ip, n AS ip_long
  FROM (SELECT *, {_order_address('l_orderkey')} AS n FROM lineitem)
)"""

_SPEND = """
spend AS (
  SELECT ip, ip_long, CAST(sum(CAST(price AS DECIMAL(18, 6))) AS DOUBLE) AS sump
  FROM sales GROUP BY ip, ip_long
)"""

_OWNERS = f"""
owners AS (
  SELECT n, p, geoname_id, n // {_SIZE} * {_SIZE} AS start_ip,
         n // {_SIZE} * {_SIZE} + {_SIZE} - 1 AS end_ip
  FROM (
    SELECT n, CAST(8 + n // 16777216 % 9 AS INTEGER) AS p, geoname_id
    FROM (SELECT {_spread('c_custkey')} % 3758096384 AS n, CAST(c_nationkey AS BIGINT) AS geoname_id
          FROM customer)
    UNION ALL
    SELECT {_spread('s_suppkey', 123456789)} % 3758096384, CAST(9 + s_suppkey % 5 AS INTEGER),
           CAST(s_nationkey AS BIGINT)
    FROM supplier
  )
)"""

_BLOCKS = f"""{_OWNERS},
blocks AS (
  SELECT {_dotted('start_ip')} || '/' || p AS network, p, start_ip, end_ip,
         min(geoname_id) AS geoname_id
  FROM owners GROUP BY start_ip, end_ip, p
)"""

_COUNTRIES = """
countries AS (
  SELECT CAST(n_nationkey AS BIGINT) AS geoname_id, 'en' AS locale_code,
         substr(r_name, 1, 2) AS continent_code, r_name AS continent_name,
         CASE WHEN n_nationkey % 10 <> 9 THEN 'N' || n_nationkey END AS country_iso_code,
         n_name AS country_name, n_regionkey = 3 AS is_in_e
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def _with(*tables: str) -> str:
    return "WITH " + ",".join(tables)


def _top_ip_countries(pre_k: int, low: str, high: str) -> str:
    return f"""{_with(_SALES, _SPEND, _BLOCKS, _COUNTRIES)}
SELECT sump, ip, geoname_id, country_name, network
FROM (SELECT * FROM spend ORDER BY sump DESC, ip LIMIT {pre_k}) AS t
JOIN blocks ON ip_long {low} start_ip AND ip_long {high} end_ip
JOIN countries USING (geoname_id)
ORDER BY sump DESC, ip, network, geoname_id LIMIT 10"""


def _top_countries(placed: str) -> str:
    return f"""{_with(_SALES, _SPEND, _BLOCKS, _COUNTRIES)}
SELECT country_name, CAST(sum(CAST(sump AS DECIMAL(18, 6))) AS DOUBLE) AS sump
FROM ({placed}) JOIN countries USING (geoname_id)
GROUP BY country_name ORDER BY sump DESC, country_name LIMIT 10"""


_INSIDE = "SELECT * FROM spend JOIN blocks ON ip_long BETWEEN start_ip AND end_ip"
_LONGEST = f"""{_INSIDE}
QUALIFY row_number() OVER (PARTITION BY ip ORDER BY p DESC, network, geoname_id) = 1"""

_PAIRS = f"""
pairs AS (
  SELECT *, n AS ip_long, near // {_SIZE} * {_SIZE} AS start_ip,
         near // {_SIZE} * {_SIZE} + {_SIZE} - 1 AS end_ip,
         {_dotted('n')} AS ip, {_dotted('near')} || '/' || p AS cidr
  FROM (
    SELECT n, (n + l_linenumber * 65536) % {SPACE} AS near,
           CAST(8 + l_partkey % 17 AS INTEGER) AS p
    FROM (SELECT *, {_spread('l_orderkey')} AS n FROM lineitem)
  )
)"""

_MS_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S.%g')"

_EVENT_LINES = f"""
event_lines AS (
  SELECT 'user_' || user_id || ',' || value || ',' || {_MS_TEXT} || ',' || event_type || ','
         || {_dotted(_spread('user_id'))} AS line,
         'user_' || user_id AS name, value AS price,
         date_trunc('milliseconds', ts) AS ts, event_type AS category,
         {_dotted(_spread('user_id'))} AS ip, strftime(ts, '%Y-%m-%d') AS dt,
         strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
  FROM events
)"""

_ARRIVED = f"""
arrived AS (
  SELECT CASE WHEN event_id % 97 = 7 THEN 'user_' || user_id || ',' || value
              ELSE 'user_' || user_id || ',' || value || ','
                   || CASE WHEN event_id % 89 = 5 THEN 'yesterday' ELSE {_MS_TEXT} END || ','
                   || event_type || ',' || {_dotted(_spread('user_id'))} END AS value,
         CASE WHEN event_id % 97 = 7 THEN 'too_few_fields'
              WHEN event_id % 89 = 5 THEN 'bad_time' END AS reason,
         strftime(ts, '%Y-%m-%d') AS dt, event_id, event_type AS category
  FROM events
)"""


def _draw(half: int, piece: int) -> str:
    return f"CAST('0x' || substr(md5('42:{half}:' || id), {1 + 8 * piece}, 8) AS BIGINT)"


def _gauss(u: str, v: str) -> str:
    return f"(sqrt(-2 * ln(({u} + 0.5::DOUBLE) / {SPACE})) * cos(2 * pi() * {v} / {SPACE}))"


_DRAWN = (
    "drawn AS (SELECT id, "
    + ", ".join(f"{_draw(i // 4, i % 4)} AS u{i}" for i in range(8))
    + " FROM (SELECT l_orderkey * 8 + l_linenumber AS id FROM lineitem))"
)

SQL_TWINS: dict[str, str] = {
    "preview_sales": f"""{_with(_SALES)}
SELECT name, price, ts, category, ip FROM sales
ORDER BY name, price, ts, category NULLS FIRST, ip LIMIT 10""",
    "project_rename_cast": f"""{_with(_SALES)}
SELECT name AS product, CAST(CAST(price AS FLOAT) AS DOUBLE) AS price, ip AS address
FROM sales""",
    "epoch_ms_of_events": "SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms FROM events",
    "date_parts": """SELECT event_id, t AS ts, strftime(t, '%Y-%m-%d') AS dt,
       epoch_us(t) // 1000 AS epoch_ms
FROM (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN date_trunc('milliseconds', ts) END AS t
      FROM events)""",
    "range_filter": f"""{_with(_SALES)}
SELECT name, ip, price FROM sales WHERE ip_long > 1610612736 AND ip_long < 2147483647""",
    "ip_to_long_forms": f"""
SELECT l_orderkey, l_linenumber, ip_long,
       CASE WHEN l_linenumber = 6 THEN 0 ELSE ip_long END AS ip_or_zero
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber = 2 THEN n // 65536 * 65536
                  WHEN l_linenumber NOT IN (5, 6) THEN n END AS ip_long
      FROM (SELECT *, {_order_address('l_orderkey')} AS n FROM lineitem))""",
    "cidr_bounds": f"""{_with(_OWNERS)}
SELECT {_dotted('n')} || '/' || p AS network, p AS prefix_len, start_ip, end_ip FROM owners""",
    "cidr_dotted": f"""{_with(_OWNERS)}
SELECT {_dotted('n')} || '/' || p AS network, {_dotted('start_ip')} AS first_address,
       {_dotted('end_ip')} AS last_address FROM owners""",
    "cidr_contains_pairs": f"""{_with(_PAIRS)}
SELECT ip, cidr, ip_long BETWEEN start_ip AND end_ip AS inside FROM pairs""",
    "sql_registered_functions": f"""{_with(_PAIRS)}
SELECT ip, cidr, ip_long, start_ip, end_ip, {_dotted('start_ip')} AS first_address,
       {_dotted('end_ip')} AS last_address, ip_long BETWEEN start_ip AND end_ip AS inside
FROM pairs""",
    "count_by_category": f"""{_with(_SALES)}
SELECT category, count(*) AS cnt FROM sales GROUP BY category""",
    "count_by_name_category": f"""{_with(_SALES)}
SELECT name, category, count(*) AS cnt FROM sales GROUP BY name, category""",
    "spend_by_address": f"{_with(_SALES, _SPEND)} SELECT ip, ip_long, sump FROM spend",
    "spend_by_address_long": f"{_with(_SALES, _SPEND)} SELECT ip_long, sump FROM spend",
    "sort_by_count": f"""{_with(_SALES)}
SELECT count(*) AS cnt, name FROM sales GROUP BY name ORDER BY cnt DESC, name""",
    "block_country_join": f"""{_with(_BLOCKS, _COUNTRIES)}
SELECT network, geoname_id, country_name FROM blocks JOIN countries USING (geoname_id)""",
    "category_self_join": f"""{_with(_SALES)}
SELECT p.name, p.category, p.cnt, c.cnt AS category_cnt
FROM (SELECT name, category, count(*) AS cnt FROM sales GROUP BY name, category) AS p
JOIN (SELECT category, count(*) AS cnt FROM sales GROUP BY category) AS c
  ON p.category = c.category""",
    "geo_join_inclusive": f"""{_with(_SALES, _SPEND, _BLOCKS)}
SELECT ip, sump, network, geoname_id FROM ({_INSIDE})""",
    "geo_join_shuffled": f"""{_with(_SALES, _SPEND, _BLOCKS)}
SELECT ip, sump, network, geoname_id FROM ({_INSIDE})""",
    "geo_join_strict": f"""{_with(_SALES, _SPEND, _BLOCKS)}
SELECT ip, sump, network, geoname_id
FROM spend JOIN blocks ON ip_long > start_ip AND ip_long < end_ip""",
    "geo_join_longest": f"""{_with(_SALES, _SPEND, _BLOCKS)}
SELECT ip, sump, network, geoname_id FROM ({_LONGEST})""",
    "geo_join_mixed": f"""{_with(_SALES, _SPEND, _BLOCKS)},
six AS (
  SELECT format('2001:db8:{{:x}}:{{:x}}::{{:x}}', ip_long >> 16, ip_long & 65535, ip_long % 97) AS ip, sump, ip_long
  FROM spend WHERE ip_long % 2 = 0
),
owned AS (
  SELECT n, p, geoname_id, format('2001:DB8:{{:x}}:{{:x}}::/{{}}', n >> 16, n & 65535, p) AS network
  FROM (SELECT {_spread('c_custkey')} AS n, CAST(40 + c_custkey % 25 AS INTEGER) AS p,
               CAST(c_nationkey AS BIGINT) AS geoname_id FROM customer)
)
SELECT ip, sump, network, geoname_id FROM ({_LONGEST})
UNION ALL
SELECT ip, sump, network, geoname_id FROM (
  SELECT ip, sump, network, geoname_id, p FROM six JOIN owned ON ip_long >> (64 - p) = n >> (64 - p)
  QUALIFY row_number() OVER (PARTITION BY ip ORDER BY p DESC, network, geoname_id) = 1
)""",
    "top_categories": f"""{_with(_SALES)}
SELECT category, count(*) AS cnt FROM sales
GROUP BY category ORDER BY cnt DESC, category NULLS FIRST LIMIT 10""",
    "top_products": f"""{_with(_SALES)}
SELECT name, category, count(*) AS cnt FROM sales WHERE category IS NOT NULL
GROUP BY ALL ORDER BY cnt DESC, name, category LIMIT 10""",
    "top_products_k100": f"""{_with(_SALES)}
SELECT name, category, count(*) AS cnt FROM sales WHERE category IS NOT NULL
GROUP BY name, category ORDER BY cnt DESC, name, category LIMIT 100""",
    "all_products_ranked": f"""{_with(_SALES)}
SELECT name, category, count(*) AS cnt FROM sales WHERE category IS NOT NULL
GROUP BY name, category ORDER BY cnt DESC, name, category""",
    "top_products_per_category": f"""{_with(_SALES)}
SELECT category, name, cnt, CAST(rank AS INTEGER) AS rank
FROM (SELECT category, name, count(*) AS cnt,
             row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, name) AS rank
      FROM sales WHERE category IS NOT NULL GROUP BY category, name)
WHERE rank <= 10""",
    "top_ips": f"""{_with(_SALES, _SPEND)}
SELECT ip, sump FROM spend ORDER BY sump DESC, ip LIMIT 10""",
    "top_ips_pruned": f"""{_with(_SALES, _SPEND)}
SELECT ip, sump FROM spend ORDER BY sump DESC, ip LIMIT 10""",
    "top_ip_countries": _top_ip_countries(100, ">=", "<="),
    "top_ip_countries_k10": _top_ip_countries(10, ">", "<"),
    "top_countries": _top_countries(_LONGEST),
    "top_countries_all": _top_countries(_INSIDE),
    "top_countries_longest": _top_countries(_LONGEST),
    "view_top_ips": f"""{_with(_SALES, _SPEND)}
SELECT ip, ip_long AS iip, sump FROM spend ORDER BY sump DESC, ip LIMIT 10""",
    "view_block_bounds": f"""{_with(_BLOCKS)}
SELECT geoname_id, start_ip AS startip, end_ip AS endip FROM blocks""",
    "view_product_report": f"""{_with(_SALES)}
SELECT strftime(ts, '%Y-%m-%d') AS dt, min(epoch_us(ts) // 1000) AS first_ms,
       max(ip_long) AS max_ip, count(*) AS cnt
FROM sales WHERE category IS NOT NULL GROUP BY 1""",
    "csv_roundtrip": f"""{_with(_SALES)}
SELECT name, price, ts, coalesce(category, '') AS category, ip FROM sales""",
    "purchase_lines_roundtrip": f"""{_with(_SALES)}
SELECT '"' || name || '" \\' AS name, price, ts, category, ip FROM sales""",
    "quoted_csv_roundtrip": f"""{_with(_COUNTRIES)}
SELECT s_suppkey AS geoname_id, locale_code, continent_code, continent_name, country_iso_code,
       country_name || ', the "' || s_name || '" of \\' AS country_name, is_in_e
FROM supplier JOIN countries ON s_nationkey = geoname_id""",
    "blocks_csv_roundtrip": f"""{_with(_BLOCKS)}
SELECT network, geoname_id, geoname_id AS registered_country_geoname_id,
       CASE WHEN geoname_id % 7 = 0 THEN geoname_id END AS represented_country_geoname_id,
       geoname_id % 5 = 0 AS is_anonymous_proxy, p = 9 AS is_satellite_provider,
       p AS prefix_len, start_ip, end_ip
FROM blocks""",
    "reference_rejects": f"""WITH owned AS (
  SELECT {_dotted(_spread('c_custkey'))} || '/16' AS network, {_spread('c_custkey')} // 65536 * 65536 AS first_ip,
         c_custkey AS k, c_nationkey AS id FROM customer
),
lines AS (
  SELECT CASE WHEN k % 53 = 5 THEN network || ',abc,' || id || ',' || id || ',0,1'
              WHEN k % 59 = 7 THEN network || ',' || id END AS rejected, id, first_ip
  FROM owned
)
SELECT rejected, CASE WHEN rejected IS NULL THEN CAST(id AS BIGINT) END AS geoname_id,
       CASE WHEN rejected IS NULL THEN true END AS is_satellite_provider, count(*) AS lines,
       CAST(min(CASE WHEN rejected IS NULL THEN first_ip END) AS BIGINT) AS first_ip
FROM lines GROUP BY 1, 2, 3""",
    "partitioned_roundtrip": f"""{_with(_EVENT_LINES)}
SELECT name, price, ts, category, ip, dt FROM event_lines""",
    "partition_pruning": f"""{_with(_EVENT_LINES)}
SELECT dt, category, count(*) AS cnt FROM event_lines
WHERE dt BETWEEN '2024-01-05' AND '2024-01-07' GROUP BY dt, category""",
    "purchase_table": f"""{_with(_EVENT_LINES)}
SELECT name, price, ts, category, ip, dt FROM event_lines""",
    "ymd_partition_roundtrip": f"""{_with(_EVENT_LINES)}
SELECT line AS value, year, month, day FROM event_lines""",
    "text_roundtrip": f"""{_with(_SALES)}
SELECT name || ',' || price || ',' || coalesce(category, '') || ',' || ip AS value FROM sales""",
    "rolled_files": "SELECT count(*) AS lines, true AS within_limit FROM lineitem",
    "rows_with_schema": f"""{_with(_SALES)}
SELECT category, name, count(*) AS cnt FROM sales WHERE category IS NOT NULL
GROUP BY category, name""",
    "cached_multi_sink": f"{_with(_SALES, _SPEND)} SELECT ip, sump FROM spend",
    "synthetic_sales": f"""WITH {_DRAWN}
SELECT id, 'product' || ((u0 * 20) >> 32) AS name,
       round({_gauss('u3', 'u4')} * 10 + 500, 1) AS price,
       TIMESTAMP '2010-10-15 00:00:00' + to_milliseconds(
         ((u5 * 7) >> 32) * 86400000 + CAST(trunc({_gauss('u6', 'u7')} * 86400000) AS BIGINT)
       ) AS ts,
       'category' || ((u1 * 20) >> 32) AS category, {_dotted('u2')} AS ip
FROM drawn""",
    "stream_by_date": f"""{_with(_ARRIVED)}
SELECT value, dt FROM arrived WHERE reason IS NULL""",
    "stream_growing_files": f"""{_with(_ARRIVED)}
SELECT value, dt FROM arrived WHERE reason IS NULL""",
    "stream_fanout": f"""{_with(_ARRIVED)}
SELECT sink, CASE WHEN sink = 'raw' THEN 'all' ELSE dt END AS dt, count(*) AS lines,
       max(value) AS last_line
FROM arrived, (VALUES ('product'), ('event'), ('raw')) AS s(sink)
WHERE reason IS NULL GROUP BY 1, 2""",
    "stream_committed": f"""{_with(_ARRIVED)}
SELECT sink, CASE WHEN sink = 'raw' THEN 'all' ELSE dt END AS dt, count(*) AS lines,
       max(value) AS last_line
FROM arrived, (VALUES ('product'), ('raw')) AS s(sink)
WHERE reason IS NULL GROUP BY 1, 2""",
    "stream_supervised": f"""{_with(_ARRIVED)}
SELECT value, dt FROM arrived WHERE reason IS NULL
UNION ALL SELECT name, 'unreadable_file' FROM (VALUES ('a.txt.gz'), ('b.txt.gz')) AS bad(name)""",
    "stream_kept_reports": f"""{_with(_ARRIVED)},
good AS (
  SELECT split_part(value, ',', 1) AS name, category, split_part(value, ',', 5) AS ip,
         CAST(split_part(value, ',', 2) AS DECIMAL(18, 6)) AS price
  FROM arrived WHERE reason IS NULL
)
(SELECT 'categories' AS report, category AS item, CAST(count(*) AS DOUBLE) AS amount
 FROM good GROUP BY category ORDER BY amount DESC, item LIMIT 10)
UNION ALL
(SELECT 'products', name || '/' || category, CAST(count(*) AS DOUBLE) AS cnt
 FROM good GROUP BY name, category ORDER BY cnt DESC, name, category LIMIT 10)
UNION ALL
(SELECT 'ips', ip, CAST(sum(price) AS DOUBLE) AS sump FROM good GROUP BY ip ORDER BY sump DESC, ip LIMIT 10)""",
    "ingest_table_report": f"""{_with(_ARRIVED)}
SELECT category, count(*) AS cnt FROM arrived WHERE reason IS NULL
GROUP BY category ORDER BY cnt DESC, category LIMIT 10""",
    "spend_exact": """SELECT '10.0.0.' || l_linenumber AS ip, CAST(167772160 + l_linenumber AS BIGINT) AS ip_long,
  CAST(sum(CAST((l_orderkey % 2001 - 1000) / 1000.0::DOUBLE + 0.004::DOUBLE AS DECIMAL(18, 6))) AS DOUBLE) AS sump
FROM lineitem GROUP BY l_linenumber""",
    "batch_rejects": f"""{_with(_ARRIVED)}
SELECT CASE WHEN event_id % 83 = 11 THEN
              'odd,' || (['NaN', 'Infinity', '1e30', 'dear', '-1e12'])[event_id % 5 + 1]
              || ',2024-01-01 00:00:00,c,1.2.3.4'
            WHEN reason IS NOT NULL THEN value END AS rejected,
       CASE WHEN event_id % 83 <> 11 AND reason IS NULL THEN category END AS category,
       count(*) AS lines
FROM arrived GROUP BY 1, 2""",
    "stream_rejects": f"""{_with(_ARRIVED)}
SELECT value, reason FROM arrived WHERE reason IS NOT NULL""",
}
