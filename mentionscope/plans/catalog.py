"""Registered queries: one Spark plan per operator ID of the survey, each with
an independent DuckDB SQL statement of the same result.

Every query reads the driver's tables (or data Spark derives from them) in
full; no row caps, id subsets or prefixes. Names follow the survey IDs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timefuncs as tf
from ..functions.names import DEFAULT_LAST_KEY, KNOWN_FALSE_POSITIVES, day_string
from ..operators import articles, board, eventtime, feed, rolling, topk
from ..schema import ARTICLE_COLUMNS
from ..session import checkpoint_dir
from ..sources import fixtures as fx
from ..sources import segments
from ..streaming.sources import record_frame
from . import daily
from . import oracle_sql as q


@dataclass
class Registered:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None):
    """Register a query; it always runs with the session time zone pinned to
    UTC (event-time arithmetic is in UTC, like the oracle's TIMESTAMP)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        REGISTRY[name] = Registered(run, sql)
        return fn
    return deco


# ---------------------------------------------------------------- T1 flagship
@register("t1_daily_top_names", f"""
WITH {q.mentions_cte('month').lstrip()},
counts AS (SELECT day, name, count(*) AS mentions FROM m GROUP BY day, name),
ranked AS (SELECT day, name, mentions,
                  CAST(row_number() OVER (PARTITION BY day ORDER BY mentions DESC, name ASC) AS INTEGER) AS rank
           FROM counts)
SELECT day, name, mentions, rank FROM ranked WHERE rank <= 10""")
def t1_daily_top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 (flagship, entry A): the ten most-mentioned names per day, lenient reading."""
    lines = fx.article_lines(spark, sf_dir, grain="month")
    return topk.daily_top_names(articles.mentions(lines, "rdd"), k=10)


def ntz(c):
    """Output timestamps as TIMESTAMP_NTZ (zone-free, like the oracle's TIMESTAMP)."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _lines(spark, sf_dir, grain="day"):
    return fx.article_lines(spark, sf_dir, grain)


def _users(spark, sf_dir):
    return fx.event_mentions(spark, sf_dir, "user_id")


def _types(spark, sf_dir):
    return fx.event_mentions(spark, sf_dir, "event_type")


def _user_changelog(spark, sf_dir):
    return rolling.rolling_changelog(_users(spark, sf_dir), ts="ts", key="name", id_col="id")


def _hourly_boards(spark, sf_dir, n=100):
    latest = board.latest_in_bucket(_user_changelog(spark, sf_dir), "1 hour")
    return board.boards(latest, n)


# ------------------------------------------------ parsing
@register("p1_article_fields", f"""
WITH {q.rdd_parsed_cte('day').lstrip()}
SELECT id, key, n_fields, day, allnames FROM acc""")
def p1_article_fields(spark, sf_dir):
    """P1 TAB split (trailing empties dropped), P2 names-field test, P11 key, F2 day."""
    parsed = articles.parse_articles(_lines(spark, sf_dir), "rdd", keep=("id",))
    return articles.accepted(parsed).select("id", "key", "n_fields", "day", "allnames")


def _typed_sql() -> str:
    cols = []
    for i, (name, _h, _t) in enumerate(ARTICLE_COLUMNS, start=1):
        raw = q.csv_value_sql(f"f[{i}]")
        if name == "timestamp":
            expr = f"CASE WHEN {q.ts_ok_sql(raw)} THEN try_strptime({raw}, '%Y%m%d%H%M%S') END"
        elif name == "sourcetype":
            expr = f"TRY_CAST({raw} AS INTEGER)"
        else:
            expr = raw
        cols.append(f'{expr} AS "{name}"')
    stamp, stype = q.csv_value_sql("f[2]"), q.csv_value_sql("f[3]")
    return f"""
WITH {q.lines_cte('day').lstrip()},
sp AS (SELECT string_split(value, chr(9)) AS f FROM lines)
SELECT {', '.join(cols)}
FROM sp
WHERE len(f) = 27 AND ({stamp} IS NULL OR {q.ts_ok_sql(stamp)})
  AND ({stype} IS NULL OR TRY_CAST({stype} AS INTEGER) IS NOT NULL)
  AND NOT {q.OPEN_QUOTE_SQL}"""


@register("s3_typed_articles", _typed_sql())
def s3_typed_articles(spark, sf_dir):
    """Strict 27-column typed records (empty -> NULL)."""
    t = articles.typed_articles(_lines(spark, sf_dir))
    return t.withColumn("timestamp", ntz("timestamp"))


@register("t1_ds_daily_top_names", f"""
WITH {q.strict_cte('month').lstrip()},
m0 AS (SELECT day, unnest({q.split_names_sql('allnames')}) AS name FROM sacc),
m AS (SELECT * FROM m0 WHERE NOT contains(name, 'Category')),
counts AS (SELECT day, name, count(*) AS mentions FROM m GROUP BY day, name),
ranked AS (SELECT day, name, mentions,
                  CAST(row_number() OVER (PARTITION BY day ORDER BY mentions DESC, name ASC) AS INTEGER) AS rank
           FROM counts)
SELECT day, name, mentions, rank FROM ranked WHERE rank <= 10""")
def t1_ds_daily_top_names(spark, sf_dir):
    """T1 under the strict (typed) reading with the substring stop rule."""
    return topk.daily_top_names(articles.mentions(_lines(spark, sf_dir, "month"), "ds"), k=10)


@register("st1_stream_mentions", f"""
WITH {q.mentions_cte('day', keep_empty=False, stop_exact=(), needs_day=False).lstrip()}
SELECT key, name FROM m""")
def st1_stream_mentions(spark, sf_dir):
    """ST1/P6/P7 (batch twin): split -> filter -> explode under the record key, empty names dropped."""
    return articles.mentions(_lines(spark, sf_dir), "stream", keep=("key",))


@register("a1_name_counts", f"""
WITH {q.mentions_cte('day').lstrip()}
SELECT day, name, count(*) AS mentions FROM m GROUP BY day, name""")
def a1_name_counts(spark, sf_dir):
    """Mentions per (day, name), map-side combined."""
    return topk.count_mentions(articles.mentions(_lines(spark, sf_dir), "rdd"))


@register("a3_daily_top_lists", f"""
WITH {q.mentions_cte('month').lstrip()},
counts AS (SELECT day, name, count(*) AS mentions FROM m GROUP BY day, name),
ranked AS (SELECT day, name, mentions,
                  row_number() OVER (PARTITION BY day ORDER BY mentions DESC, name ASC) AS rank
           FROM counts)
SELECT day, CAST(to_json(list({{'name': name, 'mentions': mentions}} ORDER BY rank)) AS VARCHAR) AS top_json
FROM ranked WHERE rank <= 10 GROUP BY day""")
def a3_daily_top_lists(spark, sf_dir):
    """A3 + P12: per day the ordered top-10 list (as JSON text)."""
    top = topk.daily_top_names(articles.mentions(_lines(spark, sf_dir, "month"), "rdd"), k=10)
    return topk.top_lists(top).select("day", F.to_json("top").alias("top_json"))


@register("t3_top_names_overall", f"""
WITH {q.mentions_cte('day').lstrip()}
SELECT name, count(*) AS mentions FROM m GROUP BY name ORDER BY mentions DESC, name ASC LIMIT 100""")
def t3_top_names_overall(spark, sf_dir):
    """Global sort by mentions, first 100 (a top-k report)."""
    m = articles.mentions(_lines(spark, sf_dir), "rdd")
    return topk.global_top(topk.count_mentions(m, ("name",)), 100)


@register("t2_names_by_mentions", f"""
WITH {q.mentions_cte('day').lstrip()}
SELECT name, count(*) AS mentions FROM m GROUP BY name ORDER BY mentions DESC, name ASC""")
def t2_names_by_mentions(spark, sf_dir):
    """Every name in order of its mentions (a range-partitioned sort, no cut)."""
    m = articles.mentions(_lines(spark, sf_dir), "rdd")
    return topk.by_mentions(topk.count_mentions(m, ("name",)))


@register("t4_queue_head_flag", f"""
WITH {q.lines_cte('day').lstrip()}
SELECT id, (row_number() OVER (ORDER BY id)) <= 1000 AS in_head FROM lines""")
def t4_queue_head_flag(spark, sf_dir):
    """T4: split an ordered queue into its first 1000 rows and the rest."""
    return topk.split_first_n(_lines(spark, sf_dir).select("id"), 1000, ["id"])


@register("p10_stop_list_top", f"""
WITH {q.mentions_cte('month', stop_exact=KNOWN_FALSE_POSITIVES, stop_contains=('Category',)).lstrip()},
counts AS (SELECT day, name, count(*) AS mentions FROM m GROUP BY day, name),
ranked AS (SELECT day, name, mentions,
                  CAST(row_number() OVER (PARTITION BY day ORDER BY mentions DESC, name ASC) AS INTEGER) AS rank
           FROM counts)
SELECT day, name, mentions, rank FROM ranked WHERE rank <= 10""")
def p10_stop_list_top(spark, sf_dir):
    """Daily top-10 without a stop-name list (anti-join) and substring rule."""
    m = articles.mentions(_lines(spark, sf_dir, "month"), "rdd")
    stop = spark.createDataFrame([(n,) for n in KNOWN_FALSE_POSITIVES], "name string")
    m = articles.drop_stop_names(m, stop).where(~F.col("name").contains("Category"))
    return topk.daily_top_names(m, k=10)


@register("f10_record_ids", f"""
WITH {q.lines_cte('day').lstrip()},
k AS (SELECT id, split_part(value, chr(9), 1) AS key FROM lines),
p AS (SELECT id, key, string_split(regexp_replace(key, '-+$', ''), '-') AS parts FROM k),
n AS (SELECT id, key, len(parts) = 2 AND regexp_full_match(parts[1], '[+]?[0-9]+') AND regexp_full_match(parts[2], '[+]?[0-9]+')
             AND TRY_CAST(parts[1] AS BIGINT) IS NOT NULL AND TRY_CAST(parts[2] AS BIGINT) IS NOT NULL AS ok, parts FROM p)
SELECT id, key, CASE WHEN ok THEN TRY_CAST(parts[1] AS BIGINT) ELSE 0 END AS stamp_no,
       CASE WHEN ok THEN TRY_CAST(parts[2] AS BIGINT) ELSE 0 END AS seq_no
FROM n""")
def f10_record_ids(spark, sf_dir):
    """record id ``stamp-seq`` -> two longs, (0, 0) on any failure."""
    from ..functions.names import parse_record_id, record_key
    k = _lines(spark, sf_dir).select("id", record_key("value").alias("key"))
    a, b = parse_record_id("key")
    return k.select("id", "key", a.alias("stamp_no"), b.alias("seq_no"))


@register("a7_distinct_names_per_day", f"""
WITH {q.mentions_cte('day').lstrip()}
SELECT day, count(DISTINCT name) AS n_names FROM m GROUP BY day""")
def a7_distinct_names_per_day(spark, sf_dir):
    """Distinct names per day (exact)."""
    return topk.distinct_keys(articles.mentions(_lines(spark, sf_dir), "rdd"), ["day"])


@register("a7_sketched_names", f"""
WITH {q.mentions_cte('day').lstrip()}
SELECT date_trunc('month', day)::DATE AS month, count(DISTINCT name) AS n_names, true AS within FROM m GROUP BY 1""")
def a7_sketched_names(spark, sf_dir):
    """A7, mergeable: a sketch per day, united per month; the estimate lies within four
    standard errors of the exact count (which the query also returns). Both read the same shuffle
    of the mentions; a null-safe join leaves no filter that tells their plans apart."""
    m = articles.mentions(_lines(spark, sf_dir), "rdd").repartition("day", "name")
    month = F.trunc("day", "month").alias("month")
    estimate = topk.merge_sketches(topk.sketch_keys(m, ["day"]).select(month, "sketch"), ["month"], out="estimate")
    exact = topk.distinct_keys(m.select(month, "name"), ["month"])
    off = F.abs(F.col("estimate") - F.col("n_names")) / F.col("n_names")
    bound = 4 * 1.04 / 2 ** (topk.LG_K / 2)
    return exact.join(estimate.withColumnRenamed("month", "__month"), F.col("month").eqNullSafe(F.col("__month"))).select("month", "n_names", (off <= F.lit(bound)).alias("within"))


@register("k1_incremental_days", f"""
WITH {q.mentions_cte('month').lstrip()},
counts AS (SELECT day, name, count(*) AS mentions FROM m GROUP BY day, name),
ranked AS (SELECT day, name, mentions,
                  CAST(row_number() OVER (PARTITION BY day ORDER BY mentions DESC, name ASC) AS INTEGER) AS rank
           FROM counts)
SELECT day, name, mentions, rank FROM ranked WHERE rank <= 10""")
def k1_incremental_days(spark, sf_dir):
    """S7 -> A1 -> T1 -> K1: the daily top-10 kept as day tables, the segments taken in two
    runs; the ranks equal those of one full run."""
    base = f"{checkpoint_dir(spark)}/days-{uuid.uuid4().hex}"
    lines = _lines(spark, sf_dir, "month").withColumn("file", F.concat(F.lit("segment-"), F.pmod(F.xxhash64("id"), F.lit(4)).cast("string")))
    for part in (F.col("file") <= "segment-1", F.col("file") > "segment-1"):
        daily.ingest(spark, lines.where(part), base)
        daily.rank_days(spark, base)
    return daily.top_table(spark, base)


@register("s11_last_key", f"""
WITH {q.lines_cte('day').lstrip()}
SELECT coalesce(arg_max(split_part(value, chr(9), 1), id), '{DEFAULT_LAST_KEY}') AS last_key FROM lines""")
def s11_last_key(spark, sf_dir):
    """Key of the last record of the log (ordered by id), default when empty."""
    from ..functions.names import record_key
    log = _lines(spark, sf_dir).select(record_key("value").alias("key"), F.col("id").alias("offset"))
    return segments.last_key(log)


# ------------------------------------------------------ segments
_SEG_SQL = "time_bucket(INTERVAL 15 MINUTES, ts)"


@register("s5_manifest_head", f"""
WITH {q.events_cte().lstrip()},
seg AS (SELECT DISTINCT {_SEG_SQL} AS s FROM ev),
man AS (SELECT epoch(s)::BIGINT AS pos,
               'http://data.example.org/v2/gkg/' || strftime(s, '%Y%m%d%H%M00') || '.gkg.csv' AS line FROM seg),
head AS (SELECT * FROM man ORDER BY pos LIMIT 100)
SELECT pos, regexp_extract(line, '/v2/gkg/[0-9]*\\.gkg\\.csv', 0) AS bucket_path,
       regexp_extract(line, '[0-9]*\\.gkg\\.csv', 0) AS file_name FROM head""")
def s5_manifest_head(spark, sf_dir):
    """First 100 lines of a segment manifest, path and name extracted."""
    ev = _types(spark, sf_dir)
    seg = ev.select(tf.floor_segment("ts").alias("s")).distinct()
    man = seg.select(F.unix_seconds("s").alias("pos"),
                     F.concat(F.lit("http://data.example.org/"), tf.segment_key(F.col("s"))).alias("line"))
    return segments.manifest_head(man, 100)


@register("s11_last_keys", f"""
WITH {q.events_cte().lstrip()},
lg AS (SELECT {_SEG_SQL} AS topic, id, strftime(ts, '%Y%m%d%H%M%S') || '-' || CAST(id AS VARCHAR) AS key FROM ev),
r AS (SELECT min(topic) AS lo, max(topic) AS hi FROM lg),
t AS (SELECT unnest(generate_series(lo, hi, INTERVAL 15 MINUTES)) AS topic FROM r),
l AS (SELECT topic, arg_max(key, id) AS last_key FROM lg GROUP BY topic)
SELECT t.topic, coalesce(l.last_key, '{DEFAULT_LAST_KEY}') AS last_key FROM t LEFT JOIN l ON t.topic = l.topic""")
def s11_last_keys(spark, sf_dir):
    """The last key of every 15-minute segment's log, the default where a segment is empty."""
    ev = _types(spark, sf_dir)
    key = F.concat_ws("-", F.date_format("ts", "yyyyMMddHHmmss"), F.col("id").cast("string"))
    log = ev.select(tf.floor_segment("ts").alias("topic"), key.alias("key"), F.col("id").alias("offset"))
    ends = log.agg(F.min("topic").alias("lo"), F.max("topic").alias("hi"))
    topics = ends.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 15 MINUTES"))).alias("topic"))
    return segments.last_keys(log, topics).withColumn("topic", ntz("topic"))


@register("f9_segment_names", f"""
WITH {q.events_cte().lstrip()},
st AS (SELECT id, strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM ev),
mi AS (SELECT id, strptime(left(stamp, 12), '%Y%m%d%H%M') AS minute FROM st)
SELECT id, minute,
       time_bucket(INTERVAL 15 MINUTES, minute) AS seg_start,
       time_bucket(INTERVAL 15 MINUTES, minute) + INTERVAL 15 MINUTES AS next_seg,
       time_bucket(INTERVAL 15 MINUTES, minute) - INTERVAL 15 MINUTES AS last_full,
       strftime(time_bucket(INTERVAL 15 MINUTES, minute), '%Y%m%d%H%M00') || '.gkg.csv' AS file_name,
       'v2/gkg/' || strftime(time_bucket(INTERVAL 15 MINUTES, minute), '%Y%m%d%H%M00') || '.gkg.csv' AS object_key
FROM mi""")
def f9_segment_names(spark, sf_dir):
    """F6 stamp -> minute, F7 next quarter, F8 last full quarter, F9 file name, F16 key."""
    ev = _types(spark, sf_dir)
    minute = tf.stamp_minute(F.date_format("ts", "yyyyMMddHHmmss"))
    d = ev.select("id", minute.alias("minute"))
    seg = tf.floor_segment("minute")
    return d.select("id", ntz("minute").alias("minute"), ntz(seg).alias("seg_start"),
                    ntz(tf.next_segment("minute")).alias("next_seg"),
                    ntz(tf.last_full_segment("minute")).alias("last_full"),
                    tf.segment_name(seg).alias("file_name"), tf.segment_key(seg).alias("object_key"))


@register("s6_segment_lists", f"""
WITH {q.events_cte().lstrip()},
w AS (SELECT id, {_SEG_SQL} - INTERVAL 15 MINUTES AS last FROM ev),
x AS (SELECT id, unnest(generate_series(last - INTERVAL 45 MINUTES, last, INTERVAL 15 MINUTES)) AS segment_start FROM w)
SELECT id, segment_start, strftime(segment_start, '%Y%m%d%H%M00') || '.gkg.csv' AS file_name FROM x""")
def s6_segment_lists(spark, sf_dir):
    """For every record time as "now", the four segments of the last hour."""
    ev = _types(spark, sf_dir).select("id", F.col("ts").alias("now"))
    out = segments.wanted_segments(ev, "now", 60)
    return out.select("id", ntz("segment_start").alias("segment_start"), "file_name")


@register("s7_new_segments", f"""
WITH {q.events_cte().lstrip()},
listed AS (SELECT DISTINCT strftime({_SEG_SQL}, '%Y%m%d%H%M00') || '.gkg.csv' AS file_name FROM ev),
seen AS (SELECT DISTINCT strftime({_SEG_SQL}, '%Y%m%d%H%M00') || '.gkg.csv' AS file_name FROM ev
         WHERE name = 'view')
SELECT file_name FROM listed WHERE file_name NOT IN (SELECT file_name FROM seen)""")
def s7_new_segments(spark, sf_dir):
    """Listed segments minus those already ingested (anti-join, not a high-water mark)."""
    ev = _types(spark, sf_dir)
    named = ev.select(tf.segment_name(tf.floor_segment("ts")).alias("file_name"), "name")
    listed = named.select("file_name").distinct()
    seen = named.where(F.col("name") == "view").select("file_name")
    return segments.new_segments(listed, seen)


@register("f12_after_marks", f"""
WITH {q.events_cte().lstrip()},
listed AS (SELECT DISTINCT name, strftime({_SEG_SQL}, '%Y%m%d%H%M00') || '.gkg.csv' AS file_name FROM ev),
mid AS (SELECT name, epoch_ms((min(epoch_ms(ts)) + max(epoch_ms(ts))) // 2) AS ts FROM ev GROUP BY name),
marks AS (SELECT name, strftime({_SEG_SQL}, '%Y%m%d%H%M00') || '.gkg.csv' AS mark FROM mid)
SELECT l.name, l.file_name FROM listed l JOIN marks k ON l.name = k.name WHERE l.file_name > k.mark""")
def f12_after_marks(spark, sf_dir):
    """per feed (event type) the segments whose name sorts after its mark, the middle of its time."""
    ev = _types(spark, sf_dir)
    listed = ev.select("name", tf.segment_name(tf.floor_segment("ts")).alias("file_name")).distinct()
    ms = F.unix_millis("ts")
    mid = ev.groupBy("name").agg(F.min(ms).alias("lo"), F.max(ms).alias("hi"))
    at = F.timestamp_millis(F.expr("(lo + hi) div 2"))
    marks = mid.select("name", tf.segment_name(tf.floor_segment(at)).alias("mark"))
    return segments.after_marks(listed, marks, feed="name")


# ----------------------------------------------------------- event time
@register("e1_event_time_spread", f"""
WITH {q.events_cte().lstrip()},
x AS (SELECT id, date_trunc('day', ts) AS segment,
             row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY id) - 1 AS line_no,
             count(*) OVER (PARTITION BY date_trunc('day', ts)) AS n_lines FROM ev)
SELECT id, segment, line_no, n_lines,
       epoch_ms(epoch_ms(segment) + line_no * (900000 // n_lines)) AS event_ts FROM x""")
def e1_event_time_spread(spark, sf_dir):
    """Row i of n in a segment gets start + i * (15 min div n)."""
    ev = _types(spark, sf_dir).withColumn("segment", F.date_trunc("day", "ts"))
    out = eventtime.spread_event_times(ev, "segment", "id", F.col("segment"))
    return out.select("id", ntz("segment").alias("segment"), "line_no", "n_lines",
                      ntz("event_ts").alias("event_ts"))


@register("k2_record_frame", f"""
WITH {q.lines_cte('day').lstrip()},
k AS (SELECT id, value, id // {64 * fx.ID_SPAN} AS segment, split_part(value, chr(9), 1) AS key FROM lines),
s AS (SELECT *, CASE WHEN regexp_full_match(substr(key, 1, 12), '[0-9]{{12}}') THEN try_strptime(substr(key, 1, 12), '%Y%m%d%H%M') END AS minute FROM k),
st AS (SELECT segment, arg_min(minute, id) FILTER (WHERE minute IS NOT NULL) AS start FROM s GROUP BY segment),
x AS (SELECT s.*, row_number() OVER (PARTITION BY segment ORDER BY id) - 1 AS line_no, count(*) OVER (PARTITION BY segment) AS n FROM s)
SELECT key, value, CAST(0 AS INTEGER) AS partition, epoch_ms(epoch_ms(start) + line_no * (900000 // n)) AS event_ts,
       CAST(epoch_ms(start) + line_no * (900000 // n) AS VARCHAR) AS event_ts_ms
FROM x JOIN st ON x.segment = st.segment""")
def k2_record_frame(spark, sf_dir):
    """K2 + E1: the replayed record of every article line - key, value, partition and event time
    (also as a header), 64 orders to a segment, from the stamp of the segment's first line."""
    lines = _lines(spark, sf_dir).withColumn("segment", F.expr(f"id div {64 * fx.ID_SPAN}"))
    rec = record_frame(eventtime.replay_times(lines, "segment", "id"))
    header = F.decode(rec["headers"][0]["value"], "UTF-8").alias("event_ts_ms")
    return rec.select("key", "value", "partition", ntz("event_ts").alias("event_ts"), header)


_DELAY_DAYS = 365


@register("st6_rejected_mentions", f"""
WITH {q.lines_cte('day').lstrip()},
k AS (SELECT id, id // {64 * fx.ID_SPAN} AS batch, substr(split_part(value, chr(9), 1), 1, 12) AS head FROM lines),
s AS (SELECT id, batch, CASE WHEN regexp_full_match(head, '[0-9]{{12}}') THEN try_strptime(head, '%Y%m%d%H%M') END AS ts FROM k),
b AS (SELECT batch, max(ts) AS top FROM s GROUP BY batch),
w AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {_DELAY_DAYS} DAYS AS mark FROM b)
SELECT id, ts, CASE WHEN ts IS NULL THEN 'no time' ELSE 'late' END AS reason
FROM s JOIN w ON s.batch = w.batch WHERE ts IS NULL OR ts < mark""")
def st6_rejected_mentions(spark, sf_dir):
    """ST5/ST6 (batch twin): article lines in arrival order, 64 orders to a micro-batch - those
    without an event time and those older than the watermark their batch meets, with the reason."""
    from ..functions.names import record_key
    lines = _lines(spark, sf_dir).select("id", F.expr(f"id div {64 * fx.ID_SPAN}").alias("batch"),
                                         tf.stamp_minute(record_key("value")).alias("ts"))
    told = rolling.late(lines, "batch", delay_us=_DELAY_DAYS * 24 * rolling.HOUR_US)
    reason = F.when(F.col("ts").isNull(), rolling.NO_TIME).when(F.col("late"), rolling.LATE)
    return told.select("id", ntz("ts").alias("ts"), reason.alias("reason")).where("reason IS NOT NULL")


@register("e5_segment_rates", f"""
WITH {q.events_cte().lstrip()}
SELECT {_SEG_SQL} AS segment_start, count(*) AS n_lines, count(*) // 900 AS per_second,
       900000 // count(*) AS step_ms
FROM ev GROUP BY 1""")
def e5_segment_rates(spark, sf_dir):
    """E5: rows per 15-minute segment and the replay rate/spacing they need."""
    ev = _types(spark, sf_dir).withColumn("segment_start", ntz(tf.floor_segment("ts")))
    return eventtime.segment_rates(ev, "segment_start")


@register("f4_day_strings", f"""
WITH {q.events_cte().lstrip()}
SELECT id, strftime(ts, '%Y-%m-%d') AS day FROM ev""")
def f4_day_strings(spark, sf_dir):
    """``yyyy-MM-dd`` text of every record time."""
    return _types(spark, sf_dir).select("id", day_string("ts").alias("day"))


# ------------------------------------------------------- rolling counts
@register("e3_rolling_hour_counts", f"""
WITH {q.events_cte().lstrip()}
SELECT id, name, ts,
       count(*) OVER (PARTITION BY name ORDER BY ts
                      RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS count
FROM ev""")
def e3_rolling_hour_counts(spark, sf_dir):
    """Per mention, mentions of its name in the hour up to it (closed start)."""
    out = rolling.rolling_counts(_types(spark, sf_dir), ts="ts", key="name", id_col="id")
    return out.withColumn("ts", ntz("ts"))


@register("e4_rolling_changelog", f"""
WITH {q.changelog_cte('event_type').lstrip()}
SELECT name, id, t, delta, count FROM ch""")
def e4_rolling_changelog(spark, sf_dir):
    """E4/ST2/ST3 (batch twin): every +1 and -1 with the running one-hour count."""
    out = rolling.rolling_changelog(_types(spark, sf_dir), ts="ts", key="name", id_col="id")
    return out.withColumn("t", ntz("t"))


@register("st4_sliding_hour_counts", f"""
WITH {q.events_cte().lstrip()},
x AS (SELECT name, time_bucket(INTERVAL 15 MINUTES, ts) - i * INTERVAL 15 MINUTES AS window_start
      FROM ev, range(0, 4) r(i))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, name, count(*) AS count
FROM x GROUP BY ALL""")
def st4_sliding_hour_counts(spark, sf_dir):
    """ST4 (batch twin): counts in one-hour windows sliding every 15 minutes."""
    out = rolling.sliding_counts(_types(spark, sf_dir), ts="ts", key="name")
    return out.select(ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"),
                      "name", "count")


# ----------------------------------------------- board and feed
@register("a6_latest_per_name", f"""
WITH {q.changelog_cte('user_id').lstrip()},
x AS (SELECT date_trunc('day', t) AS bucket, name, count,
             row_number() OVER (PARTITION BY date_trunc('day', t), name
                                ORDER BY t DESC, delta DESC, id DESC) AS rn FROM ch)
SELECT bucket, name, count FROM x WHERE rn = 1""")
def a6_latest_per_name(spark, sf_dir):
    """Upsert view of the changelog - last count per (day, name)."""
    out = board.latest_in_bucket(_user_changelog(spark, sf_dir), "1 day")
    return out.withColumn("bucket", ntz("bucket"))


@register("t6_hourly_boards", f"""
WITH {q.boards_cte(100).lstrip()}
SELECT bucket, name, count, rank FROM board""")
def t6_hourly_boards(spark, sf_dir):
    """T6 exact: per hour the 100 names with the highest latest rolling count."""
    return _hourly_boards(spark, sf_dir).withColumn("bucket", ntz("bucket"))


@register("st8_board_tombstones", f"""
WITH {q.boards_cte(100).lstrip()},
prev AS (SELECT bucket + INTERVAL 1 HOUR AS bucket, name FROM board)
SELECT p.bucket, p.name, CAST(0 AS BIGINT) AS count FROM prev p
WHERE NOT EXISTS (SELECT 1 FROM board b WHERE b.bucket = p.bucket AND b.name = p.name)""")
def st8_board_tombstones(spark, sf_dir):
    """ST8: names that left the board between consecutive hours, published as 0."""
    return board.tombstones(_hourly_boards(spark, sf_dir)).withColumn("bucket", ntz("bucket"))


@register("a5_board_minimum", f"""
WITH {q.boards_cte(100).lstrip()}
SELECT bucket, arg_min(name, (count, name)) AS name, min(count) AS count FROM board GROUP BY bucket""")
def a5_board_minimum(spark, sf_dir):
    """A5: per board, the entry a newcomer must beat (lowest count, then name)."""
    return board.board_minimum(_hourly_boards(spark, sf_dir)).withColumn("bucket", ntz("bucket"))


@register("k4_board_messages", f"""
WITH {q.boards_cte(100).lstrip()}
SELECT bucket, CAST(0 AS INTEGER) AS chunk, count(*) AS n_entries,
       CAST(to_json(list({{'name': name, 'count': count}} ORDER BY rank)) AS VARCHAR) AS message
FROM board GROUP BY bucket""")
def k4_board_messages(spark, sf_dir):
    """Each hourly board as one JSON array message, in rank order."""
    b = _hourly_boards(spark, sf_dir)
    out = feed.json_messages(b, ["bucket"], ["rank"], "name", "count")
    return out.withColumn("bucket", ntz("bucket"))


@register("k5_conflated_feed", f"""
WITH {q.changelog_cte('user_id').lstrip()},
e AS (SELECT time_bucket(INTERVAL 1 SECOND, t) AS slot, name,
             arg_max(count, (t, delta, id)) AS count, min((t, delta, id)) AS first_seq
      FROM ch GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY first_seq) AS pos FROM e)
SELECT slot, CAST((pos - 1) // 1000 AS INTEGER) AS chunk, count(*) AS n_entries,
       CAST(to_json(list({{'name': name, 'count': count}} ORDER BY pos)) AS VARCHAR) AS message
FROM r GROUP BY 1, 2""")
def k5_conflated_feed(spark, sf_dir):
    """K5: per second, the last count of each changed name in first-seen order."""
    out = feed.conflated_feed(_user_changelog(spark, sf_dir), max_entries=1000)
    return out.withColumn("slot", ntz("slot"))


@register("k5_board_feed", f"""
WITH {q.boards_cte(100).lstrip()},
prev AS (SELECT bucket + INTERVAL 1 HOUR AS bucket, name FROM board),
tomb AS (SELECT p.bucket, p.name, CAST(0 AS BIGINT) AS count FROM prev p
         WHERE NOT EXISTS (SELECT 1 FROM board b WHERE b.bucket = p.bucket AND b.name = p.name)),
fd AS (SELECT bucket, name, count FROM board UNION ALL SELECT bucket, name, count FROM tomb),
r AS (SELECT bucket AS slot, name, count, row_number() OVER (PARTITION BY bucket ORDER BY name) AS pos FROM fd)
SELECT slot, CAST((pos - 1) // 1000 AS INTEGER) AS chunk, count(*) AS n_entries,
       CAST(to_json(list({{'name': name, 'count': count}} ORDER BY pos)) AS VARCHAR) AS message
FROM r GROUP BY 1, 2""")
def k5_board_feed(spark, sf_dir):
    """K5 over what the boards publish: per hour every seat and a 0 for each name that left."""
    changes = board.published(_hourly_boards(spark, sf_dir))
    out = feed.conflated_feed(changes, max_entries=1000, every="1 hour", t="bucket", seq=("bucket", "name"), bounded=True)
    return out.withColumn("slot", ntz("slot"))


@register("k6_board_snapshot", f"""
WITH {q.boards_cte(100).lstrip()},
prev AS (SELECT bucket + INTERVAL 1 HOUR AS bucket, name FROM board),
tomb AS (SELECT p.bucket, p.name, CAST(0 AS BIGINT) AS count FROM prev p
         WHERE NOT EXISTS (SELECT 1 FROM board b WHERE b.bucket = p.bucket AND b.name = p.name)),
fd AS (SELECT bucket, name, count FROM board UNION ALL SELECT bucket, name, count FROM tomb)
SELECT name, arg_max(count, bucket) AS count, max(bucket) AS bucket FROM fd GROUP BY name""")
def k6_board_snapshot(spark, sf_dir):
    """K6: snapshot for a new subscriber - last published value of every name (zeros kept)."""
    return board.board_snapshot(_hourly_boards(spark, sf_dir)).withColumn("bucket", ntz("bucket"))


# ------------------------------------------------------------- misc
@register("u1_union_mentions", f"""
WITH {q.mentions_cte('day', keep_empty=False, stop_exact=(), needs_day=False).lstrip()},
{q.events_cte('user_id').lstrip()},
u AS (SELECT name FROM m UNION ALL SELECT name FROM ev)
SELECT name, count(*) AS mentions FROM u GROUP BY name""")
def u1_union_mentions(spark, sf_dir):
    """Bag union of two mention sources (article lines and the event log), counted."""
    a = articles.mentions(_lines(spark, sf_dir), "stream", keep=()).select("name")
    b = _users(spark, sf_dir).select("name")
    return topk.count_mentions(segments.union_sources(a, b), ("name",))


@register("s10_utf8_documents", """
SELECT doc_id, text FROM documents""")
def s10_utf8_documents(spark, sf_dir):
    """Whole document texts with malformed UTF-8 dropped (valid text untouched)."""
    from ..sources.text import repair_utf8
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", repair_utf8("text").alias("text"))


@register("s10_repaired_bytes", r"""
SELECT doc_id, regexp_replace(text, '[\x{80}-\x{7FF}]', '', 'g') AS text,
       (length(text) - length(regexp_replace(text, '[\x{80}-\x{7FF}]', '', 'g')))::BIGINT AS n_cut FROM documents""")
def s10_repaired_bytes(spark, sf_dir):
    """S10 on malformed bytes: every two-byte character of the documents is cut after its
    first byte; the repair drops what is left of it and nothing else."""
    from ..sources.text import repair_utf8
    d = fx.table(spark, sf_dir, "documents")
    # As bytes, one character each: a first byte of two, then the byte that goes with it.
    pairs = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    cut = F.regexp_replace(pairs, "([\u00c2-\u00df])[\u0080-\u00bf]", "$1")
    raw = F.encode(cut, "ISO-8859-1").cast("string")
    n_cut = (F.length(pairs) - F.length(cut)).cast("long")
    return d.select("doc_id", raw.alias("raw"), n_cut.alias("n_cut")).select("doc_id", repair_utf8("raw").alias("text"), "n_cut")


@register("f13_url_parts", r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
       regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages""")
def f13_url_parts(spark, sf_dir):
    """regex extraction of host and path from page URLs."""
    p = fx.table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("host"),
                    F.regexp_extract("url", r"^[a-z]+://[^/?#]+([^?#]*)", 1).alias("path"))
