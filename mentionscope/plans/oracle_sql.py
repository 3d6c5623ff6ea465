"""SQL text of the derived fixtures and parse rules, for the DuckDB oracle.

These are independent, plain-SQL statements of the same rules the Spark
operators implement; the driver runs them on the same parquet tables.
"""

from __future__ import annotations

from ..sources.fixtures import EDGE_DAY, EDGE_LINES, ID_SPAN, LINES

TAB = "chr(9)"
DELIM = ",[0-9;]+"


def packed_cte(grain: str = "day") -> str:
    ts = "o.o_orderdate" if grain == "day" else "date_trunc('month', o.o_orderdate)"
    return f"""
items AS (
  SELECT l.l_orderkey, (l.l_linenumber - 1) // {LINES} AS block,
         string_agg(concat_ws(' ', p.p_name, p.p_brand) || ',' || CAST(l.l_linenumber AS VARCHAR), ';'
                    ORDER BY l.l_linenumber, concat_ws(' ', p.p_name, p.p_brand)) AS allnames
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2),
packed AS (
  SELECT CAST(o.o_orderkey AS BIGINT) * {ID_SPAN} + i.block AS id, CAST({ts} AS TIMESTAMP) AS ts, i.allnames
  FROM orders o JOIN items i ON o.o_orderkey = i.l_orderkey)"""


def edge_cte(grain: str = "day") -> str:
    day = f"DATE '{EDGE_DAY}' + CAST(c_custkey % 365 AS INTEGER)"
    if grain == "month":
        day = f"date_trunc('month', {day})"
    listed = ", ".join("'" + x.replace("'", "''") + "'" for x in EDGE_LINES)
    return f"""
edge0 AS (
  SELECT CAST(c_custkey AS BIGINT) * {ID_SPAN} + {ID_SPAN // 2} AS id, c_name,
         strftime(CAST({day} AS TIMESTAMP), '%Y%m%d%H%M%S') AS stamp,
         [{listed}][CAST(c_custkey % {len(EDGE_LINES)} AS INTEGER) + 1] AS line FROM customer),
edge AS (
  SELECT id, replace(replace(replace(line, '{{S}}', stamp), '{{K}}', CAST(id AS VARCHAR)), '{{N}}', c_name) AS value
  FROM edge0)"""


def lines_cte(grain: str = "day") -> str:
    empties = ", ".join(["''"] * 20)
    return packed_cte(grain) + "," + edge_cte(grain) + f""",
lines AS (
  SELECT id, concat_ws({TAB},
           strftime(ts, '%Y%m%d%H%M%S') || '-' || CAST(id AS VARCHAR),
           strftime(ts, '%Y%m%d%H%M%S'), '1', {empties},
           allnames,
           CASE WHEN id % 3 = 0 THEN 'am' ELSE '' END, '', '') AS value
  FROM packed
  UNION ALL SELECT id, value FROM edge)"""


def split_names_sql(s: str, delim: str = DELIM) -> str:
    stripped = f"regexp_replace({s}, '({delim})+$', '')"
    return (f"CASE WHEN {s} = '' THEN ['']::VARCHAR[] "
            f"WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({stripped}, '{delim}') END")


def day_from_stamp_sql(s: str) -> str:
    head = f"substr({s}, 1, greatest(length({s}) - 6, 0))"
    return (f"CASE WHEN regexp_full_match({head}, '[0-9]{{8}}') "
            f"THEN CAST(try_strptime({head}, '%Y%m%d') AS DATE) END")


def rdd_parsed_cte(grain: str = "day", needs_day: bool = True) -> str:
    """Lenient parse: key, day, allnames of accepted lines (table ``acc``)."""
    day_ok = f"{day_from_stamp_sql('f[2]')} IS NOT NULL" if needs_day else "TRUE"
    return lines_cte(grain) + f""",
fields AS (
  SELECT id, value, string_split(rtrim(value, {TAB}), {TAB}) AS f FROM lines),
acc AS (
  SELECT id, split_part(value, {TAB}, 1) AS key, CAST(len(f) AS INTEGER) AS n_fields,
         {day_from_stamp_sql('f[2]')} AS day, f[24] AS allnames
  FROM fields
  WHERE len(f) > 23 AND {day_ok})"""


def mentions_cte(grain: str = "day", keep_empty: bool = True, stop_exact=("Type ParentCategory",),
                 stop_contains=(), needs_day: bool = True) -> str:
    """Exploded mentions ``m(day, name)`` of the lenient reading."""
    arr = split_names_sql("allnames")
    if not keep_empty:
        arr = f"list_filter({arr}, lambda x: x <> '')"
    where = ["TRUE"]
    for s in stop_exact:
        where.append(f"name <> '{s}'")
    for s in stop_contains:
        where.append(f"NOT contains(name, '{s}')")
    return rdd_parsed_cte(grain, needs_day) + f""",
m0 AS (SELECT id, key, day, unnest({arr}) AS name FROM acc),
m AS (SELECT * FROM m0 WHERE {' AND '.join(where)})"""


def events_cte(name: str = "event_type") -> str:
    return f"""
ev AS (SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS ts, CAST({name} AS VARCHAR) AS name FROM events)"""


def csv_value_sql(x: str) -> str:
    """A field as the CSV reader returns it: a field that is one quoted text loses its
    quotes (escape: backslash), text after an inner quote stays as it is, empty -> NULL."""
    return (f"NULLIF(CASE WHEN regexp_full_match({x}, '\"([^\"\\\\]|\\\\.)*\" *') "
            f"THEN replace(substr({x}, 2, length(rtrim({x}, ' ')) - 2), '\\\"', '\"') ELSE {x} END, '')")


# A quote that nothing closes within its field takes the TABs behind it.
OPEN_QUOTE_SQL = ("list_bool_or(list_transform(f, lambda x: "
                  "regexp_full_match(x, '\"([^\"\\\\]|\\\\.)*\\\\?')))")


def ts_ok_sql(s: str) -> str:
    return f"(regexp_full_match({s}, '[0-9]{{14}}') AND try_strptime({s}, '%Y%m%d%H%M%S') IS NOT NULL)"


def strict_cte(grain: str = "day") -> str:
    """Strict (typed 27-field) reading: ``sacc(id, key, ts, day, allnames)``."""
    return lines_cte(grain) + f""",
sfields AS (SELECT id, value, string_split(value, {TAB}) AS f FROM lines),
sacc AS (
  SELECT id, f[1] AS key, try_strptime({csv_value_sql('f[2]')}, '%Y%m%d%H%M%S') AS ts,
         CAST(try_strptime({csv_value_sql('f[2]')}, '%Y%m%d%H%M%S') AS DATE) AS day,
         {csv_value_sql('f[24]')} AS allnames
  FROM sfields
  WHERE len(f) = 27 AND {ts_ok_sql(csv_value_sql('f[2]'))}
    AND ({csv_value_sql('f[3]')} IS NULL OR TRY_CAST({csv_value_sql('f[3]')} AS INTEGER) IS NOT NULL)
    AND NOT {OPEN_QUOTE_SQL}
    AND {csv_value_sql('f[24]')} IS NOT NULL)"""


def changelog_cte(name: str = "user_id", span: str = "1 HOUR") -> str:
    """Rolling changelog ``ch(name, id, t, delta, count)`` over ``events``."""
    return events_cte(name) + f""",
ch0 AS (SELECT name, id, ts AS t, 1 AS delta FROM ev
        UNION ALL SELECT name, id, ts + INTERVAL {span} AS t, -1 AS delta FROM ev),
ch AS (SELECT name, id, t, delta,
              CAST(sum(delta) OVER (PARTITION BY name ORDER BY t, delta, id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS count
       FROM ch0)"""


def boards_cte(n: int = 100) -> str:
    """Hourly exact boards ``board(bucket, name, count, rank)`` over the user changelog."""
    return changelog_cte("user_id") + f""",
lastb AS (SELECT date_trunc('hour', t) AS bucket, name, count,
                 row_number() OVER (PARTITION BY date_trunc('hour', t), name
                                    ORDER BY t DESC, delta DESC, id DESC) AS rn FROM ch),
latest AS (SELECT bucket, name, count FROM lastb WHERE rn = 1),
board AS (SELECT * FROM (
            SELECT bucket, name, count,
                   CAST(row_number() OVER (PARTITION BY bucket ORDER BY count DESC, name ASC) AS INTEGER) AS rank
            FROM latest) WHERE rank <= {n})"""
