"""Every operator as a query over the shared tables, with the same question in SQL.

The tables hold events, orders and documents instead of packets, so a few
expressions stand in for packet fields: a probability from the event value, a
label from the event type, the hour as capture window, and a messy text column.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.contract import FeatureContract, Thresholds, resolve_thresholds, split_supported
from packetloom.functions.text import (
    boolean_word,
    clean_category,
    first_value,
    is_missing,
    joined,
    parse_numeric,
    safe_name,
    text_of,
)
from packetloom.functions.time import duration_text, iso_text, iso_time, window_key
from packetloom.operators import calibrate, dashboard, distribution, evaluate, profile, shape, summary, training
from packetloom.operators.typing import type_columns
from packetloom.plans import jobs
from packetloom.session import configure, materialise, shared_folder
from packetloom.sinks import tables as sinks
from packetloom.sources import csv as csv_source
from packetloom.sources import tables as table_source
from packetloom.sources.windows import read_documents
from packetloom.streaming import packet_job, window_job

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

RULE = Thresholds(record=0.5, file_max=0.5, file_ratio=0.4, min_records=10)
AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
HOUR = 3600
CAPTURE, PAUSE = 1800, 300
TREES = training.TreeSettings(trees=3, depth=3, bins=32)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""

    def register(f: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(configure(spark), sf_dir)

        QUERIES[f.__name__] = prepared
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ------------------------------------------------------------------- fixtures

# The messy texts, by event_id modulo 16; 0 stands for the id itself.
RAW_TEXTS = {
    1: " 12.5 ", 2: "0x1F", 3: "true", 4: "No", 5: "N/A", 6: "", 7: None, 8: "7|8;9",
    9: "5;6", 10: "1,2", 11: "12d", 12: "1e3", 13: "none|3", 14: "HTTP/1.1", 15: "-0.5",
}


def raw_text() -> Column:
    kind = F.col("event_id") % 16
    result = F.when(kind == 0, F.col("event_id").cast("string"))
    for k, text in RAW_TEXTS.items():
        result = result.when(kind == k, F.lit(text).cast("string"))
    return result


def probability() -> Column:
    return F.col("value") / (F.col("value") + 20)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.date_trunc("hour", "ts").alias("w"),
        F.col("event_type").alias("source_file"),
        probability().alias(summary.PROBABILITY),
        (F.col("event_type") == "error").cast("int").alias("y"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("raw", raw_text())


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.with_window_label(
        summary.probability_summary(scored(spark, sf_dir), ["w"], RULE.record), RULE
    )


def hourly_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows in the shape of the predictions table, stamped one day after the data."""
    start = F.col("w")
    named = summary.probability_summary(scored(spark, sf_dir), ["w"], RULE.record).select(
        "*",
        F.lit(0).alias("window_id"),
        window_key(F.lit(0), start).alias("stream_file"),
        iso_text(start).alias("window_start"),
        iso_text(start + F.make_dt_interval(hours=F.lit(1))).alias("window_end"),
        F.lit("eth0").alias("interface"),
        F.lit("live_capture").alias("source_path"),
    )
    return window_job.predictions_table(named, RULE, F.lit(AT))


# The same fixtures in SQL.
SQL_RAW = "CASE event_id % 16 WHEN 0 THEN event_id::VARCHAR " + " ".join(
    f"WHEN {k} THEN " + ("NULL" if t is None else "'" + t + "'") for k, t in RAW_TEXTS.items()
) + " END"
SQL_MISSING = "({c} IS NULL OR lower(trim({c}, ' \t\n\r')) IN ('', 'nan', 'none', 'null', 'na', 'n/a', '<nan>'))"
SQL_FIRST = (
    "CASE WHEN contains({c}, '|') THEN trim(split_part({c}, '|', 1)) "
    "WHEN contains({c}, ';') THEN trim(split_part({c}, ';', 1)) ELSE {c} END"
)


def sql_missing(c: str) -> str:
    return SQL_MISSING.format(c=c)


def sql_first(c: str) -> str:
    return SQL_FIRST.format(c=c)


def sql_number(c: str) -> str:
    f = sql_first(f"trim({c})")
    return (
        f"CASE WHEN {sql_missing(c)} THEN NULL WHEN lower({f}) IN ('true', 'yes') THEN 1.0 "
        f"WHEN lower({f}) IN ('false', 'no') THEN 0.0 "
        f"WHEN regexp_full_match({f}, '0x[0-9a-fA-F]+') THEN TRY_CAST({f} AS BIGINT)::DOUBLE "
        f"WHEN regexp_full_match({f}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST({f} AS DOUBLE) END"
    )


def sql_category(c: str) -> str:
    return f"CASE WHEN {sql_missing(c)} THEN '__MISSING__' ELSE trim({c}) END"


S = (
    "s AS (SELECT event_id, ts, user_id, event_type, value, date_trunc('hour', ts)::TIMESTAMP AS w, "
    "value / (value + 20) AS p, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y FROM events)"
)
R = f"r AS (SELECT *, {SQL_RAW} AS raw FROM events)"
MEASURES = (
    "count(*) AS records, count(*) FILTER (p >= 0.5) AS attack_records, "
    "count(*) FILTER (p >= 0.5) / count(*) AS attack_record_ratio, avg(p) AS mean_attack_probability, "
    "median(p) AS median_attack_probability, quantile_cont(p, 0.95) AS p95_attack_probability, "
    "max(p) AS max_attack_probability"
)
H = f"""h AS (SELECT *, CASE WHEN records < 10 THEN 0 WHEN max_attack_probability >= 0.5 AND attack_record_ratio >= 0.4
  THEN 1 ELSE 0 END AS window_pred_label FROM (SELECT w, {MEASURES} FROM s GROUP BY w))"""
ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"
P = f"""p AS (SELECT 'window_000000_' || strftime(w, '%Y%m%d_%H%M%S') || '.json' AS stream_file, 0 AS window_id,
  strftime(w, {ISO}) AS window_start, strftime(w + INTERVAL 1 HOUR, {ISO}) AS window_end, 'eth0' AS interface,
  'live_capture' AS source_path, records::INT AS record_count, attack_records::INT AS attack_records,
  attack_record_ratio, mean_attack_probability, median_attack_probability, p95_attack_probability,
  max_attack_probability, 0.5::DOUBLE AS record_threshold, 0.5::DOUBLE AS file_max_threshold,
  0.4::DOUBLE AS file_ratio_threshold, 10 AS min_records, window_pred_label,
  greatest(0.0, epoch(TIMESTAMP '2024-02-01') - epoch(w + INTERVAL 1 HOUR))::DOUBLE AS detection_latency_seconds,
  '2024-02-01T00:00:00+00:00' AS created_at FROM h)"""


def sql_rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


PROBS = sql_rounded(
    "attack_record_ratio", "mean_attack_probability", "median_attack_probability", "p95_attack_probability",
    "max_attack_probability",
)
PREDICTION_COLUMNS = (
    f"stream_file AS _id, window_id, stream_file, window_start, window_end, interface, source_path, record_count, "
    f"attack_records, {PROBS}, record_threshold, file_max_threshold, file_ratio_threshold, min_records, "
    f"window_pred_label, detection_latency_seconds, created_at"
)


# ------------------------------------------------- windows, files, decisions


@query(f"WITH {S}, {H}, {P} SELECT {PREDICTION_COLUMNS} FROM p")
def window_predictions(spark, d):
    return rounded(hourly_predictions(spark, d))


@query(
    f"""WITH {S}, {H}, {P} SELECT stream_file AS _id, window_id, stream_file, window_start, window_end, interface,
  source_path, record_count, attack_records,
  {sql_rounded("attack_record_ratio", "max_attack_probability", "mean_attack_probability")},
  'window_pred_label=1' AS reason, detection_latency_seconds, created_at FROM p WHERE window_pred_label = 1"""
)
def window_alerts(spark, d):
    return rounded(window_job.alerts_table(hourly_predictions(spark, d)))


@query(
    f"""WITH {S}, {H} SELECT w, records, attack_records, {PROBS}, window_pred_label,
  CASE window_pred_label WHEN 1 THEN 'ATTACK' ELSE 'BENIGN' END AS label_text FROM h"""
)
def window_labels(spark, d):
    return rounded(summary.with_label_text(hourly(spark, d)))


FILE_SQL = f"""WITH {S}, g AS (SELECT event_type AS source_file, {MEASURES} FROM s GROUP BY event_type)
  SELECT source_file, records, attack_records AS malicious_records, round(attack_record_ratio, 6) AS malicious_record_ratio,
  {sql_rounded("mean_attack_probability", "median_attack_probability", "p95_attack_probability", "max_attack_probability")},
  max_attack_probability >= 0.5 AS file_pass_max_probability_rule,
  attack_record_ratio >= 0.4 AS file_pass_ratio_rule,
  CASE WHEN max_attack_probability >= 0.5 AND attack_record_ratio >= 0.4 THEN 1 ELSE 0 END AS file_pred_label FROM g"""


@query(FILE_SQL)
def file_summary(spark, d):
    return rounded(summary.file_summary(scored(spark, d), RULE))


@query(FILE_SQL)
def file_summary_split_keys(spark, d):
    """The plan for files too large for one task, on the same rows."""
    return rounded(summary.file_summary(scored(spark, d), RULE, split=True, limit=1000))


@query(FILE_SQL.replace(S, S.replace("event_type,", "nullif(event_type, 'view') AS event_type,")))
def file_summary_null_key_split(spark, d):
    """The same plan with a null file name, which is a file like others."""
    rows = scored(spark, d).withColumn("source_file", F.nullif(F.col("source_file"), F.lit("view")))
    return rounded(summary.file_summary(rows, RULE, split=True, limit=1000))


@query(
    f"""WITH {S} SELECT event_type AS source_file, event_id, user_id, round(p, 6) AS pred_proba_attack,
  CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred_label FROM s"""
)
def record_predictions(spark, d):
    labelled = summary.with_record_label(scored(spark, d), RULE.record)
    return rounded(sinks.record_predictions(labelled, ["source_file", "event_id"], ["user.id", "tcp.flags"]))


@query(
    f"""WITH {S}, {H} SELECT '' AS window_id, strftime(w, {ISO}) AS window_start, '' AS window_end, '' AS interface,
  '' AS source_path, records, attack_records, {PROBS}, 0.5::DOUBLE AS threshold, 0.5::DOUBLE AS file_max_threshold,
  0.4::DOUBLE AS file_ratio_threshold, window_pred_label, '' AS raw_csv_path, 'tcp.b|udp.a' AS unsupported_tshark_fields FROM h"""
)
def summary_field_order(spark, d):
    _, missing = split_supported(["ip.x", "udp.a", "tcp.b"], ["ip.x"])
    rows = hourly(spark, d).withColumn("window_start", iso_text(F.col("w")))
    constants = {"unsupported_tshark_fields": joined(F.lit(missing))}
    return rounded(summary.summary_rows(rows, RULE, constants))


@query(
    f"""WITH {S}, n AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY event_id) AS k FROM s)
  SELECT w, event_id, event_type FROM n WHERE k <= 5"""
)
def row_cap_per_window(spark, d):
    rows = scored(spark, d).select("w", "event_id", "event_type")
    return summary.cap_rows(rows, ["w"], ["event_id"], 5)


@query("SELECT event_id, event_type, value FROM events WHERE event_type IN ('error', 'click') AND value > 25.5")
def user_predicate(spark, d):
    rows = summary.restrict(events(spark, d), "event_type IN ('error', 'click') AND value > 25.5")
    return rows.select("event_id", "event_type", "value")


@query(
    f"WITH {S} SELECT event_id, w, row_number() OVER (PARTITION BY w ORDER BY event_id) - 1 AS record_index FROM s"
)
def record_index(spark, d):
    return distribution.with_record_index(scored(spark, d).select("event_id", "w"), ["w"], ["event_id"])


@query(
    f"""WITH {S} SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS record_index
  FROM s"""
)
def record_index_split_keys(spark, d):
    rows = scored(spark, d).select("event_id", "event_type")
    return distribution.with_record_index(rows, ["event_type"], ["event_id"], limit=1000)


@query(
    """WITH t AS (SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS k,
    CASE WHEN event_id % 20 = 0 THEN event_id WHEN event_id % 20 <> 1 THEN 7 END AS o FROM events)
  SELECT k, o, row_number() OVER (PARTITION BY k ORDER BY o NULLS FIRST) - 1 AS record_index FROM t"""
)
def record_index_null_keys(spark, d):
    """The plan for large inputs with a null key, null order values, and one order value that nine in ten rows have."""
    n = F.col("event_id") % 20
    order = F.when(n == 0, F.col("event_id")).when(n != 1, F.lit(7).cast("long"))
    rows = events(spark, d).select(F.when(F.col("event_type") != "view", F.col("event_type")).alias("k"), order.alias("o"))
    return distribution.with_record_index(rows, ["k"], ["o"], limit=500)


@query(f"WITH {S} SELECT w, count(*) AS rows, round(count(*) / 3600, 6) AS rows_per_second FROM s GROUP BY w")
def throughput_by_window(spark, d):
    return rounded(summary.throughput(scored(spark, d), F.col("w"), HOUR, "w"))


# ------------------------------------------------------------------ functions


@query(f"WITH {R} SELECT event_id, {sql_number('raw')} AS number FROM r")
def parse_numeric_text(spark, d):
    return raw_events(spark, d).select("event_id", parse_numeric("raw").alias("number"))


@query(f"WITH {R} SELECT event_id, {sql_first('raw')} AS first_value FROM r")
def first_repeated_value(spark, d):
    return raw_events(spark, d).select("event_id", first_value("raw").alias("first_value"))


@query(f"WITH {R} SELECT event_id, {sql_category('raw')} AS category FROM r")
def clean_category_text(spark, d):
    return raw_events(spark, d).select("event_id", clean_category("raw").alias("category"))


@query(
    f"""WITH {R} SELECT event_id, CASE WHEN lower(trim(raw)) IN ('true', 'yes') THEN 1.0
  WHEN lower(trim(raw)) IN ('false', 'no') THEN 0.0 END AS flag, {sql_missing('raw')} AS missing FROM r"""
)
def boolean_and_missing_words(spark, d):
    return raw_events(spark, d).select(
        "event_id", boolean_word("raw").alias("flag"), is_missing("raw").alias("missing")
    )


@query(f"WITH {R} SELECT event_id, CASE WHEN coalesce({sql_number('raw')}, 0) > 0 THEN 1 ELSE 0 END AS label FROM r")
def binary_labels_numeric(spark, d):
    rows = raw_events(spark, d).withColumnRenamed("raw", "Attack_label")
    return profile.binary_labels(rows)[0].select("event_id", "label")


TYPE_WORD = "CASE event_type WHEN 'view' THEN ' Normal ' WHEN 'click' THEN 'BENIGN' ELSE event_type END"


def type_words() -> Column:
    t = F.col("event_type")
    return F.when(t == "view", " Normal ").when(t == "click", "BENIGN").otherwise(t)


SQL_TEXT_LABEL = f"""SELECT event_id, CASE WHEN lower(trim({TYPE_WORD})) IN ('0', 'normal', 'benign', 'false')
  THEN 0 ELSE 1 END AS label FROM events"""


@query(SQL_TEXT_LABEL)
def binary_labels_text(spark, d):
    rows = events(spark, d).withColumn("Attack_label", type_words())
    return profile.binary_labels(rows)[0].select("event_id", "label")


@query(SQL_TEXT_LABEL)
def binary_labels_type(spark, d):
    rows = events(spark, d).withColumn("Attack_type", type_words())
    return profile.binary_labels(rows)[0].select("event_id", "label")


@query(
    f"""WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' WHEN 2 THEN strftime(ts, '%Y%m%dT%H%M%S') ELSE 'junk' END AS text,
  date_trunc('second', ts) AS s FROM events)
  SELECT event_id, text, CASE event_id % 4 WHEN 0 THEN strftime(s, {ISO}) WHEN 1 THEN strftime(s - INTERVAL 2 HOUR, {ISO})
  WHEN 2 THEN strftime(s, {ISO}) END AS parsed FROM t"""
)
def iso_parse(spark, d):
    kind, ts = F.col("event_id") % 4, F.col("ts")
    text = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(kind == 2, F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .otherwise("junk")
    )
    rows = events(spark, d).select("event_id", text.alias("text"))
    return rows.select("event_id", "text", iso_text(iso_time(F.col("text"))).alias("parsed"))


@query(
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN value < 60 THEN printf('%.1fs', value)
  ELSE printf('%dm %.1fs', floor(value / 60)::BIGINT, value - floor(value / 60) * 60) END AS duration FROM events"""
)
def format_duration(spark, d):
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return events(spark, d).select("event_id", duration_text(value).alias("duration"))


@query(
    f"""WITH {S}, {H}, {P}, l AS (SELECT stream_file, CASE WHEN extract(hour FROM window_start::TIMESTAMP) % 2 = 0 THEN 1.5
  ELSE greatest(0.0, epoch(TIMESTAMP '2024-02-01') - epoch(window_end::TIMESTAMP)) END AS s FROM p)
  SELECT stream_file, s::DOUBLE AS detection_latency_seconds, CASE WHEN s < 60 THEN printf('%.1fs', s)
  ELSE printf('%dm %.1fs', floor(s / 60)::BIGINT, s - floor(s / 60) * 60) END AS detection_latency FROM l"""
)
def detection_latency(spark, d):
    stored = F.when(F.hour(iso_time(F.col("window_start"))) % 2 == 0, F.lit("1.5"))
    rows = hourly_predictions(spark, d).withColumn("detection_latency_seconds", stored)
    return dashboard.with_detection_latency(rows).select("stream_file", "detection_latency_seconds", "detection_latency")


@query(
    """SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g') AS safe_name,
  'window_' || lpad(page_id::VARCHAR, 6, '0') || '_20240201_000000.json' AS window_key FROM pages"""
)
def safe_names(spark, d):
    return table(spark, d, "pages").select(
        "page_id", safe_name(F.col("url")).alias("safe_name"), window_key(F.col("page_id"), F.lit(AT)).alias("window_key")
    )


URL_RANK = "SELECT url, dense_rank() OVER (ORDER BY url) AS window_id FROM (SELECT DISTINCT url FROM pages)"


@query(URL_RANK)
def file_window_ids(spark, d):
    return distribution.distinct_rank(table(spark, d, "pages"), "url", "window_id")


@query(URL_RANK)
def file_window_ids_split(spark, d):
    return distribution.distinct_rank(table(spark, d, "pages"), "url", "window_id", limit=50)


# --------------------------------------------------------- typing and profile


@query(
    f"""WITH {R}, t AS (SELECT raw AS v, 'raw' AS "column" FROM r UNION ALL SELECT event_type, 'event_type' FROM r
  UNION ALL SELECT value::VARCHAR, 'value' FROM r UNION ALL SELECT NULL, 'nothing' FROM r)
  SELECT "column", round(CASE WHEN count(*) FILTER (NOT {sql_missing('v')}) = 0 THEN 1.0
    ELSE count({sql_number('v')}) / count(*) FILTER (NOT {sql_missing('v')}) END, 6) AS numeric_parse_ratio,
  count(*) FILTER (NOT {sql_missing('v')}) AS non_empty_count FROM t GROUP BY "column" """
)
def numeric_parse_ratio(spark, d):
    rows = raw_events(spark, d).withColumn("nothing", F.lit(None).cast("string"))
    return rounded(profile.parse_ratios(rows, ["raw", "event_type", "value", "nothing"]))


# Texts that all parse: the numeric branch of the typing rule.
SQL_NUMERIC_RAW = "CASE WHEN event_id % 16 IN (0, 1, 2, 3, 4, 12, 15) THEN raw ELSE '0x' || lower(hex(event_id % 97)) END"


def numeric_raw() -> Column:
    parses = (F.col("event_id") % 16).isin(0, 1, 2, 3, 4, 12, 15)
    return F.when(parses, F.col("raw")).otherwise(F.concat(F.lit("0x"), F.lower(F.hex(F.col("event_id") % 97))))


@query(
    f"""WITH {R} SELECT event_id, {sql_category('raw')} AS raw, CASE WHEN event_id % 16 IN (0, 1, 2, 3, 4, 12, 15)
  THEN {sql_number('raw')} ELSE event_id % 97 END::DOUBLE AS numeric_raw, event_type, value FROM r"""
)
def coerce_types(spark, d):
    rows = raw_events(spark, d).withColumn("numeric_raw", numeric_raw())
    rows = rows.select("event_id", "raw", "numeric_raw", "event_type", "value")
    return profile.coerce_types(rows, ["raw", "numeric_raw", "event_type", "value"])


@query(f"WITH {R} SELECT event_id, {sql_category('raw')} AS raw, value FROM r")
def drop_empty_constant(spark, d):
    rows = raw_events(spark, d).select(
        "event_id",
        "raw",
        "value",
        F.lit("N/A").alias("all_missing"),
        F.lit(None).cast("string").alias("all_null"),
        F.lit("same").alias("constant_text"),
        F.lit("0x10").alias("constant_number"),
    )
    names = ["raw", "value", "all_missing", "all_null", "constant_text", "constant_number"]
    return profile.drop_empty_constant(rows, names)


@query(f"""SELECT event_id AS mqtt_len, event_type AS tcp_flags, value AS custom FROM events""")
def drop_identity_columns(spark, d):
    e = events(spark, d)
    renamed = e.select(
        F.col("event_id").alias("mqtt_len"),
        F.col("event_type").alias("tcp_flags"),
        F.col("value").alias("custom"),
        F.col("ts").alias("frame_time"),
        F.col("props").alias("tcp_payload"),
        F.col("user_id").alias("ip_src_host"),
        F.col("event_type").alias("Attack_type"),
        F.col("event_type").alias("source_file"),
    )
    return shape.select_features(shape.drop_identity_payload(renamed))


def orders_side(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.lit("web").alias("channel"),
        F.lit("n/a").alias("remark"),
        F.lit(None).cast("string").alias("clerk"),
    )


def lineitem_side(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_extendedprice",
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").alias("quantity"),
        F.lit(7).alias("channel"),
        F.col("l_returnflag").alias("remark"),
        F.lit("x").alias("clerk"),
    )


COMPARED = ["orderkey", "price", "status", "quantity", "priority", "channel", "remark", "clerk"]
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def sql_profile(name: str, prefix: str, source: str, columns: dict[str, str], order: str) -> str:
    """One row per column: the profile in SQL, from column expressions over a table."""
    parts = []
    for c in COMPARED:
        if c not in columns:
            parts.append(
                f"SELECT '{c}' AS \"column\", FALSE AS {prefix}_present, NULL::DOUBLE AS {prefix}_null_ratio, "
                f"NULL::BOOLEAN AS {prefix}_constant, NULL::DOUBLE AS {prefix}_numeric_ratio, NULL::DOUBLE AS {prefix}_min, "
                f"NULL::DOUBLE AS {prefix}_median, NULL::DOUBLE AS {prefix}_max, '' AS {prefix}_sample_values"
            )
            continue
        v = columns[c]
        kept = f"(SELECT *, {v} AS v FROM {source})"
        parts.append(
            f"SELECT '{c}' AS \"column\", TRUE AS {prefix}_present, 1 - count(t) / count(*) AS {prefix}_null_ratio, "
            f"coalesce(min(t) = max(t), TRUE) AS {prefix}_constant, "
            f"CASE WHEN count(t) = 0 THEN 1.0 ELSE count(n) / count(t) END AS {prefix}_numeric_ratio, "
            f"min(n) AS {prefix}_min, median(n) AS {prefix}_median, max(n) AS {prefix}_max, "
            f"coalesce((SELECT string_agg(v, ' | ' ORDER BY {order}) FROM (SELECT * FROM {kept} WHERE NOT {sql_missing('v')} "
            f"ORDER BY {order} LIMIT 5)), '') AS {prefix}_sample_values FROM (SELECT CASE WHEN NOT {sql_missing('v')} THEN v END AS t, "
            f"{sql_number('v')} AS n FROM {kept})"
        )
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


ORDERS_SQL = sql_profile(
    "a",
    "edge",
    "orders",
    {
        "orderkey": "o_orderkey::VARCHAR",
        "price": "o_totalprice::VARCHAR",
        "status": "o_orderstatus",
        "priority": "o_orderpriority",
        "channel": "'web'",
        "remark": "'n/a'",
        "clerk": "NULL::VARCHAR",
    },
    "o_orderkey",
)
LINEITEM_SQL = sql_profile(
    "b",
    "local",
    "lineitem",
    {
        "orderkey": "l_orderkey::VARCHAR",
        "price": "l_extendedprice::VARCHAR",
        "status": "l_linestatus",
        "quantity": "l_quantity::VARCHAR",
        "channel": "'7'",
        "remark": "l_returnflag",
        "clerk": "'x'",
    },
    ", ".join(LINEITEM_ORDER),
)
PROFILE_VALUES = ("null_ratio", "numeric_ratio", "min", "median", "max")


def sql_profile_columns(prefix: str) -> str:
    return (
        f"{prefix}_present, {prefix}_constant, {prefix}_sample_values, "
        + sql_rounded(*[f"{prefix}_{v}" for v in PROFILE_VALUES])
    )


REPORT_SQL = f"""{ORDERS_SQL}, {LINEITEM_SQL}, report AS (SELECT *, edge_present AND local_present AS present_in_both,
  CASE WHEN abs(edge_max) > 0 THEN local_max / edge_max END AS range_shift_ratio FROM a FULL OUTER JOIN b USING ("column"))"""


def compared(spark, d) -> DataFrame:
    return profile.compare_profiles(
        profile.column_profile(orders_side(spark, d), COMPARED, "edge", ["o_orderkey"]),
        profile.column_profile(lineitem_side(spark, d), COMPARED, "local", LINEITEM_ORDER),
    )


@query(f'WITH {LINEITEM_SQL} SELECT "column", {sql_profile_columns("local")} FROM b')
def column_profile(spark, d):
    return rounded(profile.column_profile(lineitem_side(spark, d), COMPARED, "local", LINEITEM_ORDER))


@query(
    f"""WITH {REPORT_SQL} SELECT "column", {sql_profile_columns("edge")}, {sql_profile_columns("local")}, present_in_both,
  round(range_shift_ratio, 6) AS range_shift_ratio FROM report"""
)
def profile_compare(spark, d):
    return rounded(compared(spark, d))


@query(
    f"""WITH {REPORT_SQL} SELECT 'edge_only' AS list_name, "column" FROM report WHERE edge_present AND NOT local_present
  UNION ALL SELECT 'local_only', "column" FROM report WHERE NOT edge_present AND local_present
  UNION ALL SELECT 'local_all_null', "column" FROM report WHERE present_in_both AND coalesce(local_null_ratio, 1) >= 1
  UNION ALL SELECT 'local_constant', "column" FROM report WHERE present_in_both AND coalesce(local_constant, FALSE)"""
)
def drift_lists(spark, d):
    return profile.drift_lists(compared(spark, d))


@query(
    f"""WITH {S} SELECT count(p) AS count, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std, round(min(p), 6) AS min,
  round(median(p), 6) AS p50, round(quantile_cont(p, 0.9), 6) AS p90, round(quantile_cont(p, 0.95), 6) AS p95,
  round(quantile_cont(p, 0.99), 6) AS p99, round(max(p), 6) AS max FROM s"""
)
def describe_probability(spark, d):
    return rounded(profile.describe(scored(spark, d), summary.PROBABILITY))


@query(ORACLE["describe_probability"])
def describe_probability_narrowed(spark, d):
    """The plan for columns too large for one task, on the same rows."""
    return rounded(profile.describe(scored(spark, d), summary.PROBABILITY, limit=1000))


@query(
    """WITH found AS (SELECT count(event_type) AS event_type, count(value) AS value,
  count(nullif(nullif(lower(trim(' n/a ')), 'n/a'), '')) AS empty_field FROM events),
  wanted AS (SELECT unnest(['event_type', 'value', 'empty_field', 'udp_port']) AS feature),
  counted AS (SELECT feature, n FROM (UNPIVOT found ON event_type, value, empty_field INTO NAME feature VALUE n))
  SELECT CASE WHEN n IS NULL THEN 'missing' ELSE 'all_empty' END AS state, feature
  FROM wanted LEFT JOIN counted USING (feature) WHERE coalesce(n, 0) = 0"""
)
def feature_coverage(spark, d):
    rows = events(spark, d).select("event_type", "value", F.lit(" n/a ").alias("empty_field"))
    names = ["event_type", "value", "empty_field", "udp_port"]
    return profile.feature_coverage(rows, FeatureContract(names, ["value"], ["event_type", "empty_field", "udp_port"]))


@query("SELECT event_type AS source_file, count(*) AS rows FROM events GROUP BY event_type")
def rows_per_file(spark, d):
    return profile.rows_per_file(scored(spark, d))


@query("SELECT y AS label, count(*) AS rows FROM (SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y FROM events) GROUP BY y")
def class_distribution(spark, d):
    return profile.class_distribution(scored(spark, d).withColumnRenamed("y", "label"))


@query(f"WITH {S} SELECT sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg, round(sum(1 - y) / sum(y), 6) AS weight FROM s")
def class_weight(spark, d):
    return rounded(training.class_weight(scored(spark, d), "y"))


# ---------------------------------------------------------------------- shape


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedup_rows(spark, d):
    return training.drop_duplicate_rows(events(spark, d).select("user_id", "event_type"))


@query("SELECT DISTINCT user_id, event_type, n FROM events CROSS JOIN (SELECT count(*) AS n FROM events)")
def dedup_rows_by_digest(spark, d):
    """Distinct rows by counting digests, with the number of all rows."""
    rows, n = training.distinct_by_digest(events(spark, d).select("user_id", "event_type"))
    return rows.withColumn("n", F.lit(n).cast("long"))


@query("SELECT event_id AS a_b, event_type AS c, value AS a_b_2 FROM events")
def header_normalize(spark, d):
    rows = events(spark, d).select("event_id", "event_type", "value", "user_id")
    return shape.normalize_columns(rows.toDF("﻿a.b ", " c", "a_b", "c "))


CONTRACT = FeatureContract(
    ["event_type", "raw", "value", "gone", "note"], ["raw", "value", "gone"], ["event_type", "note"]
)


@query(
    f"""WITH {R} SELECT event_id, 'unknown' AS source_file, event_type, {sql_number('raw')} AS raw, value, NULL::DOUBLE AS gone,
  '__MISSING__' AS note FROM r"""
)
def align_contract(spark, d):
    return shape.align_to_contract(raw_events(spark, d), CONTRACT, ["event_id", "absent"])


@query("SELECT event_id, '' AS udp_port, event_type, '' AS Attack_label FROM events")
def align_extract(spark, d):
    rows = events(spark, d).withColumn("Attack_label", F.lit("1"))
    return shape.align_extract(rows, ["event_id", "udp_port", "event_type", "Attack_label"])


@query(
    """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, NULL::INT AS nation FROM customer
  UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, s_nationkey FROM supplier"""
)
def union_by_name(spark, d):
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("name"),
    )
    return shape.union_by_name([customers, suppliers])


RECORD_FIELDS = ["event_id", "event_type", "raw", "absent"]


def documents(spark, d, **options) -> DataFrame:
    rows = raw_events(spark, d).withColumn("w", F.date_trunc("hour", "ts"))
    return shape.window_documents(
        rows, "w", ["event_id"], RECORD_FIELDS, window_seconds=HOUR, interface=F.lit("eth0"), stream_dir="/live", **options
    )


SQL_RECORD = (
    "{'event_id': event_id::VARCHAR, 'event_type': event_type, 'raw': coalesce(raw, ''), 'absent': ''}"
)
DOCS = f"""{R}, docs AS (SELECT 0 AS window_id, strftime(date_trunc('hour', ts)::TIMESTAMP, {ISO}) AS window_start,
  strftime(date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR, {ISO}) AS window_end, 'eth0' AS interface,
  'live_capture' AS source_path, 'window_000000_' || strftime(date_trunc('hour', ts)::TIMESTAMP, '%Y%m%d_%H%M%S') || '.json'
  AS stream_file, 3600 AS window_seconds, count(*)::INT AS record_count, '' AS capture_filter, '' AS display_filter,
  list({SQL_RECORD} ORDER BY event_id) AS records FROM r GROUP BY date_trunc('hour', ts))"""


def sql_record_text(records: str) -> str:
    return f"array_to_string(list_transform({records}, lambda x: x.event_id || '/' || x.event_type || '/' || x.raw || '/' || x.absent), '|')"


def record_text(records: str) -> Column:
    return F.array_join(
        F.transform(records, lambda r: F.concat_ws("/", r["event_id"], r["event_type"], r["raw"], r["absent"])), "|"
    )


@query(
    f"""WITH {DOCS} SELECT window_id, window_start, window_end, interface, source_path, stream_file,
  '/live/' || stream_file AS stream_json_path, window_seconds, record_count, capture_filter, display_filter,
  '' AS unsupported_tshark_fields, {sql_record_text('records')} AS records FROM docs"""
)
def window_documents(spark, d):
    return documents(spark, d).drop("first_record").withColumns(
        {"records": record_text("records"), "unsupported_tshark_fields": joined(F.col("unsupported_tshark_fields"))}
    )


@query(
    f"""WITH {R}, n AS (SELECT *, row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY event_id) - 1 AS i FROM r)
  SELECT 'window_000000_' || strftime(date_trunc('hour', ts)::TIMESTAMP, '%Y%m%d_%H%M%S') || '.json' AS stream_file,
  i::INT AS record_index, event_id::VARCHAR AS event_id, event_type, coalesce(raw, '') AS raw, '' AS absent FROM n"""
)
def records_explode(spark, d):
    return shape.explode_records(shape.stringify_records(documents(spark, d)), ["stream_file"])


@query(ORACLE["records_explode"])
def records_explode_split(spark, d):
    """Windows of more than five records as several documents: the same records with the same numbers."""
    docs = shape.stringify_records(documents(spark, d, records_per_document=5, limit=300))
    whole = F.regexp_replace("stream_file", shape.PART_SUFFIX, ".json")
    return shape.explode_records(docs.withColumn("stream_file", whole), ["stream_file"])


@query(
    f"""WITH {DOCS} SELECT stream_file AS _id, window_id, window_start, window_end, interface, source_path, stream_file,
  window_seconds, record_count, capture_filter, display_filter, '' AS unsupported_tshark_fields,
  {sql_record_text('records[1:25]')} AS record_preview, least(record_count, 25)::INT AS record_preview_count,
  record_count > 25 AS records_truncated, '/live/' || stream_file AS stream_json_path,
  '2024-02-01T00:00:00+00:00' AS ingested_at FROM docs"""
)
def windows_table(spark, d):
    rows = shape.windows_table(documents(spark, d), iso_text(F.lit(AT)))
    return rows.withColumns(
        {
            "record_preview": record_text("record_preview"),
            "unsupported_tshark_fields": joined(F.col("unsupported_tshark_fields")),
        }
    )


@query(
    """SELECT conv_id, role AS speaker_role, turn AS message_turn, text AS message_body_text,
  length(text) AS message_body_chars FROM conversations"""
)
def flatten_nested(spark, d):
    nested = table(spark, d, "conversations").select(
        "conv_id",
        F.struct("role").alias("speaker"),
        F.struct("turn", F.struct("text", F.length("text").cast("bigint").alias("chars")).alias("body")).alias("message"),
    )
    return shape.flatten(nested)


# ------------------------------------------------------------------ evaluation


CONFUSION = f"""WITH {S}, c AS (SELECT count(*) FILTER (y = 0 AND p < 0.5) AS tn, count(*) FILTER (y = 0 AND p >= 0.5) AS fp,
  count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 1 AND p >= 0.5) AS tp FROM s)"""


@query(
    f"""{CONFUSION} SELECT tn, fp, fn, tp, round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy,
  round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall FROM c"""
)
def confusion_metrics(spark, d):
    return rounded(evaluate.rates(evaluate.confusion(scored(spark, d), "y", summary.PROBABILITY, 0.5)))


@query(
    f"""{CONFUSION}, m AS (SELECT 'Normal' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, tn + fp AS support FROM c
  UNION ALL SELECT 'Attack', tp / (tp + fp), tp / (tp + fn), tp + fn FROM c),
  f AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM m)
  SELECT class, {sql_rounded('precision', 'recall', 'f1')}, support FROM f
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f
  UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM f"""
)
def class_report(spark, d):
    return rounded(evaluate.class_report(evaluate.confusion(scored(spark, d), "y", summary.PROBABILITY, 0.5)))


CURVE = f"""{S}, g AS (SELECT p AS score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY p),
  c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
  FROM g WINDOW w AS (ORDER BY score DESC)), c2 AS (SELECT score AS threshold, pos, neg, tp, fp, np, nn,
  tp / (tp + fp) AS precision, tp / np AS recall FROM c)"""
AREAS = f"""WITH {CURVE} SELECT round(sum(neg * (tp - pos + pos / 2)) / max(np * nn), 6) AS roc_auc,
  round(sum(pos * precision) / max(np), 6) AS pr_auc FROM c2"""


def curve(spark, d, **options) -> DataFrame:
    return evaluate.score_curve(scored(spark, d), "y", summary.PROBABILITY, **options)


@query(AREAS)
def ranking_areas(spark, d):
    return rounded(evaluate.ranking_areas(curve(spark, d)))


@query(AREAS)
def ranking_areas_split_scores(spark, d):
    """The plan for more scores than one task can order, on the same rows."""
    return rounded(evaluate.ranking_areas(curve(spark, d, limit=500)))


@query(
    """WITH s AS (SELECT CASE WHEN event_id % 9 > 0 THEN value / (value + 20) END AS p, (event_type = 'error')::INT AS y FROM events),
  c AS (SELECT p AS score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM s GROUP BY p)
  SELECT round(score, 9) AS score, pos, neg, sum(pos) OVER w::BIGINT AS cum_pos, sum(neg) OVER w::BIGINT AS cum_neg
  FROM c WINDOW w AS (ORDER BY score DESC NULLS LAST)"""
)
def score_curve_null_scores_split(spark, d):
    """The plan for large inputs with rows that have no score; they come after all scores."""
    rows = scored(spark, d).withColumn(summary.PROBABILITY, F.when(F.col("event_id") % 9 > 0, F.col(summary.PROBABILITY)))
    return rounded(evaluate.score_curve(rows, "y", summary.PROBABILITY, limit=500), 9)


@query(f"WITH {CURVE} SELECT {sql_rounded('threshold', 'precision', 'recall')} FROM c2")
def precision_recall_curve(spark, d):
    return rounded(evaluate.precision_recall(curve(spark, d)))


def sql_threshold(weight: int, floor: float = 0.0) -> str:
    allowed = f"WHERE precision >= {floor} OR NOT (SELECT bool_or(precision >= {floor}) FROM c2)" if floor else ""
    return f"""WITH {CURVE}, f AS (SELECT *, {1 + weight} * precision * recall / ({weight} * precision + recall + 1e-12) AS score
  FROM c2 {allowed}) SELECT round(threshold, 6) AS threshold, round(precision, 6) AS validation_precision,
  round(recall, 6) AS validation_recall, round(score, 6) AS validation_score FROM f ORDER BY score DESC, threshold LIMIT 1"""


@query(sql_threshold(1))
def choose_threshold_f1(spark, d):
    return rounded(evaluate.choose_threshold(curve(spark, d), "f1"))


@query(sql_threshold(4))
def choose_threshold_f2(spark, d):
    return rounded(evaluate.choose_threshold(curve(spark, d), "f2"))


@query(sql_threshold(1, 0.25))
def choose_threshold_min_precision(spark, d):
    return rounded(evaluate.choose_threshold(curve(spark, d), "f1", min_precision=0.25))


# ------------------------------------------------------------------- training


SPLIT = """WITH ranked AS (
    SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS n,
      row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id::VARCHAR || ':42'), event_id) - 1 AS k FROM events),
  cut AS (SELECT *, round(n * 0.2) AS test FROM ranked),
  named AS (SELECT event_id, event_type, CASE WHEN k < test THEN 'test'
    WHEN k < test + round((n - test) * 0.2) THEN 'validation' ELSE 'train' END AS split FROM cut)"""


@query(f"{SPLIT} SELECT event_id, event_type, split FROM named")
def stratified_split(spark, d):
    rows = events(spark, d).select("event_id", "event_type")
    return training.with_split(rows, "event_type", "event_id", name="split")


@query(f"{SPLIT} SELECT event_type, split, count(*) AS n FROM named GROUP BY ALL")
def split_counts_per_class(spark, d):
    """Exact shares of every class, by the plan for large inputs."""
    rows = events(spark, d).select("event_id", "event_type")
    split = training.with_split(rows, "event_type", "event_id", name="split", limit=500)
    return split.groupBy("event_type", "split").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {R}, n AS (SELECT event_id, {sql_number('raw')} AS n FROM r) SELECT event_id, coalesce(n, (SELECT median(n) FROM n)) AS n FROM n")
def impute_median(spark, d):
    rows = materialise(raw_events(spark, d).select("event_id", parse_numeric("raw").alias("n")), "numbers")
    return training.fill_medians(rows, training.column_medians(rows, ["n"]))


SQL_VOCABULARY = f"""{R}, l AS (SELECT 'event_type' AS "column", {sql_category('event_type')} AS value FROM r
  UNION ALL SELECT 'raw', {sql_category('raw')} FROM r UNION ALL SELECT 'user_id', user_id::VARCHAR FROM r),
  v AS (SELECT "column", value, count(*) AS rows FROM l GROUP BY ALL)"""
CATEGORIES = ["event_type", "raw", "user_id"]


def category_rows(spark, d) -> DataFrame:
    return raw_events(spark, d).select(
        "event_id", *[clean_category(text_of(c)).alias(c) for c in CATEGORIES]
    )


@query(f'WITH {SQL_VOCABULARY} SELECT "column", value, rows FROM v')
def category_frequencies(spark, d):
    return training.category_frequencies(category_rows(spark, d), CATEGORIES)


def sql_bucket(c: str, min_count: int) -> str:
    counts = f"(SELECT {c} AS value, count(*) AS n FROM k GROUP BY {c})"
    return f"CASE WHEN (SELECT n FROM {counts} x WHERE x.value = k.{c}) < {min_count} THEN '__RARE__' ELSE {c} END AS {c}"


BUCKET_MIN = 70
SQL_RARE = f"""WITH {R}, k AS (SELECT event_id, {sql_category('event_type')} AS event_type, {sql_category('raw')} AS raw,
  user_id::VARCHAR AS user_id FROM r) SELECT event_id, {sql_bucket('event_type', BUCKET_MIN)}, {sql_bucket('raw', BUCKET_MIN)},
  {sql_bucket('user_id', BUCKET_MIN)} FROM k"""


@query(SQL_RARE)
def rare_categories(spark, d):
    rows = category_rows(spark, d)
    return training.bucket_rare(rows, training.build_vocabulary(rows, CATEGORIES, BUCKET_MIN))


SQL_INDEX = f"""{SQL_VOCABULARY}, i AS (SELECT "column", value,
  row_number() OVER (PARTITION BY "column" ORDER BY rows DESC, value) - 1 AS place FROM v WHERE rows >= {BUCKET_MIN})"""


def sql_place(c: str) -> str:
    known = f"SELECT place FROM i WHERE i.\"column\" = '{c}' AND i.value = k.{c}"
    return f"coalesce(({known}), (SELECT count(*) FROM i WHERE i.\"column\" = '{c}'))::BIGINT AS {c}_place"


@query(f'WITH {SQL_INDEX} SELECT "column", value, place FROM i')
def category_index(spark, d):
    """Categories numbered by ranges of the whole order."""
    return training.build_vocabulary(category_rows(spark, d), CATEGORIES, BUCKET_MIN, limit=50).index


@query(
    f"""WITH {SQL_INDEX}, k AS (SELECT event_id, {sql_category('event_type')} AS event_type, {sql_category('raw')} AS raw,
  user_id::VARCHAR AS user_id FROM r) SELECT event_id, {', '.join(sql_place(c) for c in CATEGORIES)} FROM k"""
)
def encoded_categories(spark, d):
    """Every category as its place in its column, by the joins for long lookups."""
    rows = category_rows(spark, d)
    vocabulary = training.build_vocabulary(rows, CATEGORIES, BUCKET_MIN)
    placed = training.with_places(rows, vocabulary, CATEGORIES, listed=0)
    return placed.select("event_id", *[F.col(f"{c}__place").alias(f"{c}_place") for c in CATEGORIES])


def training_rows(spark, d) -> DataFrame:
    """Events as labelled packet rows: every column is text."""
    return raw_events(spark, d).select(
        F.col("event_id").cast("string").alias("frame_time"),
        F.col("value").cast("string").alias("tcp_len"),
        F.get_json_object("props", "$.k").alias("mqtt_len"),
        F.hour("ts").cast("string").alias("http_response"),
        F.col("raw").alias("mqtt_topic"),
        (F.col("user_id") % 7).cast("string").alias("tcp_flags"),
        F.lit("0").alias("udp_stream"),
        F.when((F.col("value") > 30) | (F.col("event_type") == "error"), "1").otherwise("0").alias("Attack_label"),
        F.col("event_type").alias("source_file"),
    )


def trained(spark, d) -> training.Bundle:
    options = jobs.TrainOptions(trees=TREES, threshold_strategy="f1", min_records=10)
    return jobs.train(spark, training_rows(spark, d).drop("source_file"), None, options).bundle


@query("SELECT event_id, round((value + event_id % 10) / (value + event_id % 10 + 20), 6) AS pred_proba_attack FROM events")
def user_function_scores(spark, d):
    """A scorer the user brings, applied to batches of rows."""

    def function(features):
        total = features["value"] + features["extra"]
        return total / (total + 20)

    rows = events(spark, d).withColumn("extra", F.col("event_id") % 10)
    return rounded(training.score_with_function(rows, ["value", "extra"], function, ["event_id"]))


@query()
def train_and_score(spark, d):
    from packetloom.plans.jobs import score

    return score(spark, trained(spark, d), training_rows(spark, d)).summary


@query()
def feature_importance(spark, d):
    typed, contract = training.prepare_training_frame(training_rows(spark, d).drop("source_file"))
    return training.top_importances(training.fit_model(typed, contract, TREES).importances(spark))


@query(
    """SELECT count(*) AS original_rows, count(*) AS rows_after_drop_duplicates, 5::BIGINT AS features_used,
  4::BIGINT AS numeric_features, 1::BIGINT AS categorical_features, 1::BIGINT AS dropped_identity_payload,
  0::BIGINT AS dropped_empty, 1::BIGINT AS dropped_constant, 'Attack_label' AS label_source FROM events"""
)
def training_report(spark, d):
    _, contract = training.prepare_training_frame(training_rows(spark, d).drop("source_file"))
    return contract.report(spark)


# ---------------------------------------------------- calibration, dashboard


def sql_baseline(min_records: int) -> str:
    return f"""WITH {S}, {H}, u AS (SELECT * FROM h WHERE records >= {min_records}
    OR NOT (SELECT bool_or(records >= {min_records}) FROM h))
  SELECT '' AS model_path, 0.5::DOUBLE AS record_threshold, 0.5::DOUBLE AS file_max_threshold,
  round(greatest(0.4, least(0.99, quantile_cont(attack_record_ratio, 0.9) + 0.05)), 6) AS file_ratio_threshold,
  {min_records} AS min_records, 0.9::DOUBLE AS baseline_quantile, 0.05::DOUBLE AS baseline_margin,
  (SELECT count(*) FROM h) AS windows_total, count(*) AS windows_used,
  round(min(attack_record_ratio), 6) AS attack_record_ratio_min, round(median(attack_record_ratio), 6) AS attack_record_ratio_median,
  round(quantile_cont(attack_record_ratio, 0.95), 6) AS attack_record_ratio_p95,
  round(max(attack_record_ratio), 6) AS attack_record_ratio_max,
  round(median(max_attack_probability), 6) AS max_attack_probability_median,
  round(quantile_cont(max_attack_probability, 0.95), 6) AS max_attack_probability_p95,
  round(max(max_attack_probability), 6) AS max_attack_probability_max FROM u"""


def calibrated(spark, d, min_records: int) -> DataFrame:
    rule = resolve_thresholds(Thresholds(min_records=min_records), RULE)
    windows = summary.blank_where_null(hourly(spark, d))
    return rounded(calibrate.baseline(windows, rule, quantile=0.9).drop("created_at", "note"))


@query(sql_baseline(10))
def baseline_calibration(spark, d):
    return calibrated(spark, d, 10)


@query(sql_baseline(1_000_000_000))
def baseline_fallback(spark, d):
    """No window has that many records, so all of them count."""
    return calibrated(spark, d, 1_000_000_000)


@query(
    f"""WITH {S}, {H}, {P} SELECT stream_file, window_end, {sql_rounded('attack_record_ratio', 'max_attack_probability')}
  FROM p WHERE window_pred_label = 1 ORDER BY window_end DESC LIMIT 50"""
)
def recent_alerts(spark, d):
    alerts = window_job.alerts_table(hourly_predictions(spark, d))
    recent = dashboard.recent(alerts, 50, "window_end")
    return rounded(recent.select("stream_file", "window_end", "attack_record_ratio", "max_attack_probability"))


@query(
    f"""WITH {S}, {H} SELECT (w + INTERVAL 1 HOUR)::TIMESTAMP AS window_end,
  {sql_rounded('attack_record_ratio', 'max_attack_probability')} FROM h ORDER BY 1"""
)
def prediction_trend(spark, d):
    return rounded(dashboard.trend(hourly_predictions(spark, d)))


@query(
    f"""WITH {S}, {H}, {P}, a AS (SELECT * FROM p WHERE window_pred_label = 1)
  SELECT (SELECT count(*) FROM p) AS windows, (SELECT count(*) FROM p) AS predictions, (SELECT count(*) FROM a) AS alerts,
  (SELECT round(arg_max(attack_record_ratio, window_end), 6) FROM p) AS latest_attack_ratio,
  (SELECT round(arg_max(max_attack_probability, window_end), 6) FROM p) AS latest_max_probability,
  (SELECT arg_max(detection_latency_seconds, window_end) FROM a) AS latest_alert_latency_seconds,
  coalesce((SELECT arg_max(CASE WHEN detection_latency_seconds < 60 THEN printf('%.1fs', detection_latency_seconds)
    ELSE printf('%dm %.1fs', floor(detection_latency_seconds / 60)::BIGINT,
    detection_latency_seconds - floor(detection_latency_seconds / 60) * 60) END, window_end) FROM a), 'n/a')
  AS latest_alert_latency"""
)
def dashboard_indicators(spark, d):
    predictions = hourly_predictions(spark, d)  # all rows share one created_at
    alerts = window_job.alerts_table(predictions)
    return rounded(dashboard.indicators(predictions, predictions, alerts))


# -------------------------------------------------------------- sinks, sources


@query(
    f"""WITH t AS (SELECT *, date_diff('day', DATE '2024-01-01', ts::DATE) AS batch_id FROM events),
  n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_id DESC, event_id DESC) AS k FROM t)
  SELECT user_id, event_id, event_type, value, batch_id::BIGINT AS batch_id FROM n WHERE k = 1"""
)
def upsert_latest(spark, d):
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("bigint")
    rows = events(spark, d).select("user_id", "event_id", "event_type", "value", day.alias("batch_id"))
    return sinks.upserted(rows, "user_id", tie_breakers=["event_id"])


@query(
    """WITH t AS (SELECT *, CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS b FROM events),
  n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY b DESC, event_id DESC) AS k FROM t)
  SELECT user_id::VARCHAR AS _id, event_id, event_type FROM n WHERE k = 1"""
)
def upsert_table(spark, d):
    """Three batches written to a keyed table, the second one twice, then read back."""
    folder = shared_folder(spark, "upsert")
    kind = F.col("event_type")
    rows = events(spark, d).select(F.col("user_id").cast("string").alias("_id"), "event_id", "event_type")
    batches = [rows.where(kind == "signup"), rows.where(kind == "view"), rows.where(~kind.isin("signup", "view"))]
    for number in (0, 1, 2, 1):
        sinks.upsert_batch(sinks.last_per_key(batches[number], "_id", ["event_id"]), folder, number)
    return sinks.read_upserted(spark, folder)


@query("SELECT user_id::VARCHAR AS _id, max(event_id) AS event_id FROM events WHERE event_type = 'signup' GROUP BY user_id")
def upsert_emptied_batch(spark, d):
    """A batch that is written again without rows leaves none of its old ones."""
    folder = shared_folder(spark, "upsert")
    rows = events(spark, d).select(F.col("user_id").cast("string").alias("_id"), "event_id", "event_type")
    rows = sinks.last_per_key(rows, "_id", ["event_id"]), sinks.last_per_key(
        rows.where("event_type = 'signup'"), "_id", ["event_id"]
    )
    sinks.upsert_batch(rows[1], folder, 0)
    sinks.upsert_batch(rows[0], folder, 1)
    sinks.upsert_batch(rows[0].limit(0), folder, 1)
    return sinks.read_upserted(spark, folder).select("_id", "event_id")


@query(
    f"""WITH {R} SELECT event_id::VARCHAR AS event_id, {sql_number('raw')} AS raw, event_type,
  'say "' || event_type || '", no' || chr(10) || '"line" ' || event_id AS payload FROM r"""
)
def csv_round_trip(spark, d):
    """Messy text, quotes, commas and line breaks through CSV files with a dirty header, read back by clean name and typed."""
    folder = shared_folder(spark, "csv")
    payload = F.concat(F.lit('say "'), "event_type", F.lit('", no\n"line" '), F.col("event_id").cast("string"))
    rows = raw_events(spark, d).select("event_id", "raw", "event_type", F.lit("again").alias("extra"), payload.alias("payload"))
    rows = rows.toDF(" event.id", "raw ", "event_type", "raw", "payload")
    rows.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option(
        "ignoreTrailingWhiteSpace", "false"
    ).option("escape", '"').csv(folder)
    back = csv_source.read_many(spark, folder, multi_line=True)
    return back.select("event_id", parse_numeric("raw").alias("raw"), "event_type", "payload")


@query(
    """SELECT event_id::VARCHAR AS mqtt_len, 'say "' || event_type || '", no' AS mqtt_msg, coalesce(value::VARCHAR, '') AS tcp_len
  FROM events"""
)
def extract_round_trip(spark, d):
    """Quotes and commas through a CSV folder, the extraction job and a plain CSV read of its output."""
    given, stored = shared_folder(spark, "given"), shared_folder(spark, "extracted")
    message = F.concat(F.lit('say "'), "event_type", F.lit('", no')).alias("mqtt.msg")
    rows = events(spark, d).select(F.col("event_id").alias("mqtt.len"), message, F.col("value").alias("tcp.len"))
    sinks.write_table(rows, given)
    jobs.extract(spark, given, stored)
    back = csv_source.read_many(spark, stored, recursive=True)
    return back.select("mqtt_len", "mqtt_msg", F.coalesce(F.col("tcp_len").cast("double").cast("string"), F.lit("")).alias("tcp_len"))


@query(
    f"""WITH {R} SELECT event_id::VARCHAR AS event_id, event_type,
  'say "' || event_type || '", no' || chr(10) || '"line" ' || event_id AS payload FROM r"""
)
def quoted_line_breaks(spark, d):
    """Records over several lines, by the plan that cuts a file into blocks."""
    folder = shared_folder(spark, "quoted")
    payload = F.concat(F.lit('say "'), "event_type", F.lit('", no\n"line" '), F.col("event_id").cast("string"))
    rows = events(spark, d).select("event_id", "event_type", payload.alias("payload"))
    sinks.write_table(rows.repartition(2), folder)
    paths = [r["path"] for r in csv_source.list_files(spark, folder).collect()]
    return csv_source.read_split_records(spark, paths, rows.columns).select(*rows.columns)


@query(
    """SELECT event_type AS source_file, count(*) AS rows, 0::BIGINT AS corrupt_rows, 'ok' AS status FROM events GROUP BY event_type"""
)
def ingest_report(spark, d):
    """Files per event type, ingested with a report; the rows tell which type a file holds."""
    folder = shared_folder(spark, "ingest")
    kinds = events(spark, d).select("event_type").distinct().orderBy("event_type").collect()
    for (kind,) in kinds:  # one file per type is the fixture
        rows = events(spark, d).where(F.col("event_type") == kind).select("event_id", "value", "event_type")
        rows.write.mode("append").option("header", "true").csv(folder)
    read, report = csv_source.ingest(spark, folder, ["event_id", "event_type", "udp.port"])
    types = read.groupBy("source_file").agg(F.max("event_type").alias("event_type"))
    return (
        report.join(types, "source_file")
        .groupBy(F.col("event_type").alias("source_file"))
        .agg(F.sum("rows").alias("rows"), F.sum("corrupt_rows").alias("corrupt_rows"), F.max("status").alias("status"))
    )


@query(f"WITH {S}, {H} SELECT strftime(w, {ISO}) AS window_start, records::VARCHAR AS records, window_pred_label::VARCHAR AS window_pred_label FROM h")
def append_summary(spark, d):
    """Window summaries appended to a CSV table in two parts and read back as text."""
    folder = shared_folder(spark, "summary")
    rows = summary.summary_rows(hourly(spark, d).withColumn("window_start", iso_text(F.col("w"))), RULE)
    rows = materialise(rows, "summary-rows")
    sinks.append_summary(rows.where("window_pred_label = 1"), folder)
    sinks.append_summary(rows.where("window_pred_label = 0"), folder)
    from packetloom.sources.tables import read_summary

    return read_summary(spark, folder).select("window_start", "records", "window_pred_label")


# ------------------------------------------------------------------- streaming


GAPPED = f"""{S}, k AS (SELECT *, make_timestamp((floor(epoch(ts) / 2100) * 2100 * 1000000)::BIGINT) AS c FROM s),
  g AS (SELECT c, {MEASURES} FROM k WHERE epoch(ts) < epoch(c) + 1800 GROUP BY c)"""


@query(
    f"""WITH {GAPPED} SELECT strftime(c, {ISO}) AS window_start, strftime(c + INTERVAL 30 MINUTE, {ISO}) AS window_end,
  records, attack_records, {PROBS} FROM g"""
)
def gapped_windows(spark, d):
    cells = packet_job.capture_cells(scored(spark, d), "ts", window_seconds=CAPTURE, pause_seconds=PAUSE)
    rows = packet_job.capture_summary(cells, RULE, window_seconds=CAPTURE)
    return rounded(rows.drop("capture_start", "window_id", "stream_file", "interface", "source_path"))


def value_scorer(records: DataFrame, keep) -> DataFrame:
    typed = type_columns(records, ["value"], ["value"], keep)
    return typed.select(*keep, probability().alias(summary.PROBABILITY))


def stored_documents(spark, d, documents_per_file: int = 1, **options) -> str:
    folder = shared_folder(spark, "live")
    rows = events(spark, d).withColumn("w", F.date_trunc("hour", "ts"))
    docs = shape.window_documents(
        rows, "w", ["event_id"], ["value"], window_seconds=HOUR, interface=F.lit("eth0"), **options
    )
    sinks.write_documents(docs, folder, documents_per_file)
    return folder


STREAMED = f"""WITH {S}, {H}, {P} SELECT stream_file AS _id, window_id, window_start, window_end, interface, record_count,
  attack_records, {PROBS}, window_pred_label FROM p"""
STREAMED_COLUMNS = [
    "_id", "window_id", "window_start", "window_end", "interface", "record_count", "attack_records",
    "attack_record_ratio", "mean_attack_probability", "median_attack_probability", "p95_attack_probability",
    "max_attack_probability", "window_pred_label",
]


@query(STREAMED)
def stream_window_scoring(spark, d):
    """Hourly documents as files, scored by the stream, read from the predictions table."""
    source = stored_documents(spark, d)
    folders = sinks.run_folders(shared_folder(spark, "stream"), fresh=True)
    run = window_job.start_window_scoring(spark, source, ["value"], value_scorer, RULE, folders, available_now=True)
    run.awaitTermination()
    return rounded(sinks.read_upserted(spark, folders.table("predictions")).select(*STREAMED_COLUMNS))


@query(STREAMED)
def batch_window_scoring(spark, d):
    """The same documents through the same function, without a stream."""
    docs = read_documents(spark, stored_documents(spark, d), ["value"])
    tables = window_job.score_documents(docs, value_scorer, RULE, at=F.lit(AT))
    return rounded(tables.predictions.select(*STREAMED_COLUMNS))


@query(STREAMED)
def window_labels_split_documents(spark, d):
    """Windows of more than five records as several documents each; their predictions are those of the whole windows."""
    # A file holds as many records as one document of the usual size.
    together = shape.RECORDS_PER_DOCUMENT // 5
    source = stored_documents(spark, d, documents_per_file=together, records_per_document=5)
    docs = read_documents(spark, source, ["value"], multi_line=False)
    tables = window_job.score_documents(docs, value_scorer, RULE, at=F.lit(AT))
    return rounded(tables.predictions.select(*STREAMED_COLUMNS))


PACKET_WINDOWS = f"""WITH {GAPPED} SELECT strftime(c, {ISO}) AS window_start,
  ((epoch(c) - min(epoch(c)) OVER ()) / 2100 + 1)::INT AS window_id,
  records::INT AS record_count, attack_records::INT AS attack_records, {PROBS} FROM g"""


def packet_stream(spark, d, source: str, **options):
    """The events of a folder as a stream of records, and its result tables."""
    schema = table(spark, d, "events").schema
    reader = spark.readStream.schema(schema).options(**options)
    rows = reader.parquet(source).select(F.col("ts").cast("timestamp").alias("ts"), probability().alias(summary.PROBABILITY))
    folders = sinks.run_folders(shared_folder(spark, "stream"), fresh=True)
    packet_job.start_packet_scoring(
        rows, "ts", RULE, folders, watermark="10 minutes", window_seconds=CAPTURE, pause_seconds=PAUSE, available_now=True
    ).awaitTermination()
    return folders


def packet_predictions(spark, folders) -> DataFrame:
    names = [c for c in STREAMED_COLUMNS if c.endswith(("_probability", "_ratio"))]
    stored = sinks.read_upserted(spark, folders.table("predictions"))
    return rounded(stored.select("window_start", "window_id", "record_count", "attack_records", *names))


@query(PACKET_WINDOWS)
def stream_packet_windows(spark, d):
    """Single events as a stream; every window, the last ones too."""
    return packet_predictions(spark, packet_stream(spark, d, d, pathGlobFilter="events.parquet"))


def late_events(spark, d) -> str:
    """Two files: every tenth event comes late, in the second one."""
    folder = shared_folder(spark, "late")
    late = F.col("event_id") % 10 == 0
    for rows in (table(spark, d, "events").where(~late), table(spark, d, "events").where(late)):
        rows.coalesce(1).write.mode("append").parquet(folder)
    return folder


@query(f"SELECT * EXCLUDE (window_id) FROM ({PACKET_WINDOWS})")
def stream_late_rows(spark, d):
    """A second micro-batch of late events corrects the windows of the first; numbers count from the first batch."""
    folders = packet_stream(spark, d, late_events(spark, d), maxFilesPerTrigger="1")
    return packet_predictions(spark, folders).drop("window_id")


@query(
    f"""WITH {S}, k AS (SELECT *, event_id % 10 = 0 AS late, make_timestamp((floor(epoch(ts) / 2100) * 2100 * 1000000)::BIGINT) AS c FROM s),
  seen AS (SELECT max(ts) AS latest FROM k WHERE NOT late)
  SELECT late::INT::BIGINT AS batch_id, count(*) AS rows, count_if(epoch(ts) < epoch(c) + 1800) AS captured_rows,
    count_if(late AND epoch(ts) < epoch(c) + 1800 AND c + INTERVAL 30 MINUTE <= latest - INTERVAL 10 MINUTE) AS late_rows
  FROM k, seen GROUP BY late"""
)
def stream_progress(spark, d):
    """Rows, captured rows and late rows of each micro-batch."""
    folders = packet_stream(spark, d, late_events(spark, d), maxFilesPerTrigger="1")
    return packet_job.read_progress(spark, folders).select("batch_id", "rows", "captured_rows", "late_rows")


# ------------------------------------------------------- tables that grow old


@query(
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 6 DESC, event_id DESC) AS k FROM events)
  SELECT user_id::VARCHAR AS _id, event_id, event_type FROM n WHERE k = 1"""
)
def compacted_table(spark, d):
    """Six batches of a keyed table with compactions in between, read from its base and the open batches."""
    folder = shared_folder(spark, "compacted")
    rows = events(spark, d).select(F.col("user_id").cast("string").alias("_id"), "event_id", "event_type")
    for number in range(6):
        batch = rows.where(F.col("event_id") % 6 == number)
        sinks.upsert_batch(sinks.last_per_key(batch, "_id", ["event_id"]), folder, number)
        if number in (2, 4):
            sinks.compact_upserted(spark, folder, keep_open=1)
    return sinks.read_upserted(spark, folder)


@query(
    """WITH n AS (SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id)
  SELECT event_id FROM n ORDER BY event_id DESC LIMIT 20"""
)
def recent_rows_of_a_table(spark, d):
    """The newest rows of a keyed table as it is stored."""
    folder = shared_folder(spark, "recent")
    rows = events(spark, d).select(F.col("user_id").cast("string").alias("_id"), "event_id")
    sinks.upsert_batch(sinks.last_per_key(rows, "_id", ["event_id"]), folder, 0)
    return table_source.recent_rows(spark, folder, 20, "event_id")


# ------------------------------------------------------------ files and folders


def typed_files(spark, d) -> str:
    """One CSV per event type, in a folder that is named after the type."""
    folder = shared_folder(spark, "types")
    rows = events(spark, d).select(F.col("event_id").alias("tcp.seq"), F.col("value").alias("tcp.len"), "event_type")
    ordered = rows.repartition(1).sortWithinPartitions("event_type", "`tcp.seq`")
    ordered.write.option("header", "true").partitionBy("event_type").csv(folder)
    return folder


@query(
    """SELECT event_id::VARCHAR AS tcp_seq, value AS tcp_len FROM events
  WHERE event_type IN (SELECT DISTINCT event_type FROM events ORDER BY event_type LIMIT 3)"""
)
def first_files_of_folders(spark, d):
    """Files found in folders below, by pattern, the first three in path order."""
    found = csv_source.read_many(spark, typed_files(spark, d), pattern="part-*.csv", recursive=True, max_files=3)
    return found.select("tcp_seq", F.col("tcp_len").cast("double").alias("tcp_len"))


@query(
    """SELECT replace(column_name, '.', '_') AS name, ordinal_position - 1 AS place
  FROM information_schema.columns WHERE table_name = 'events'"""
)
def header_of_a_file(spark, d):
    """Clean field names of a CSV header, in order."""
    folder = shared_folder(spark, "header")
    table(spark, d, "events").limit(10).coalesce(1).write.option("header", "true").csv(folder)
    path = csv_source.list_files(spark, folder).first()["path"]
    names = csv_source.header_or_default(spark, path)
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, place long")


@query(
    """SELECT CASE WHEN event_id % 3 = 0 THEN 'w' || event_id WHEN event_id % 2 = 0 THEN 'f' || event_id
  ELSE 'window_000007' END AS stream_file, count(*) AS rows FROM events GROUP BY ALL"""
)
def fallback_keys(spark, d):
    """Documents without a key are named after their file, else after the batch."""
    given = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("w"), "event_id")).when(F.col("event_id") % 3 == 1, "")
    read = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("f"), "event_id"))
    rows = events(spark, d).select(given.alias("stream_file"), read.alias("read"))
    return shape.with_window_key(rows, 7, F.col("read")).groupBy("stream_file").agg(F.count(F.lit(1)).alias("rows"))


# -------------------------------------------------------------- jobs as a whole


class ValueBundle:
    """A bundle whose score is a known function of one feature, so that SQL can state it."""

    contract = FeatureContract(["tcp_len"], ["tcp_len"], [])

    def score(self, raw: DataFrame, keep=()) -> DataFrame:
        value = parse_numeric("tcp_len")
        kept = [c for c in keep if c in raw.columns and c != "source_file"]
        return raw.select("source_file", *kept, (value / (value + 20)).alias(summary.PROBABILITY))


BUNDLE_RULE = Thresholds(record=0.5, file_max=0.5, file_ratio=0.4, min_records=10)
TYPES = f"""{S}, t AS (SELECT event_type, {MEASURES} FROM s GROUP BY event_type),
  n AS (SELECT *, row_number() OVER (ORDER BY event_type) AS window_id FROM t)"""


@query(
    f"""WITH {TYPES} SELECT window_id, records, attack_records, {PROBS},
  (records >= 10 AND max_attack_probability >= 0.5 AND attack_record_ratio >= 0.4)::INT AS window_pred_label FROM n"""
)
def replayed_windows(spark, d):
    """A folder of files, each one a window, through the replay job."""
    windows = jobs.replay(spark, ValueBundle(), typed_files(spark, d), recursive=True, thresholds=BUNDLE_RULE).summary
    measures = ("attack_record_ratio", *[f"{m}_attack_probability" for m in ("mean", "median", "p95", "max")])
    return rounded(windows.select("window_id", "records", "attack_records", *measures, "window_pred_label"))


@query(
    f"""WITH {TYPES}, r AS (SELECT window_id, s.event_id, p, row_number() OVER (PARTITION BY window_id ORDER BY event_id) - 1 AS record_index
    FROM s JOIN n USING (event_type))
  SELECT window_id, record_index, round(p, 6) AS pred_proba_attack, (p >= 0.5)::INT AS pred_label FROM r WHERE record_index < 40"""
)
def replayed_records(spark, d):
    """The first records of each replayed file, numbered in file order."""
    found = jobs.replay(
        spark, ValueBundle(), typed_files(spark, d), recursive=True, rows_per_file=40, thresholds=BUNDLE_RULE, include_metadata=False
    )
    return rounded(found.predictions.select("window_id", "record_index", summary.PROBABILITY, summary.LABEL))


@query(
    f"""WITH {TYPES} SELECT 0.5::DOUBLE AS record_threshold, 0.5::DOUBLE AS file_max_threshold,
  round(greatest(0.4, least(0.99, quantile_cont(attack_record_ratio, 0.9) + 0.05)), 6) AS file_ratio_threshold, 10 AS min_records FROM n"""
)
def calibrated_on_benign_files(spark, d):
    """Benign files replayed, their windows stored and calibrated on, and the stored baseline loaded again."""
    folder = shared_folder(spark, "calibrated")
    options = {"recursive": True, "thresholds": BUNDLE_RULE}
    jobs.calibrate_on_benign(spark, ValueBundle(), typed_files(spark, d), folder, **options)
    windows = table_source.read_summary(spark, f"{folder}/baseline_windows")
    jobs.calibrate(spark, windows, BUNDLE_RULE, f"{folder}/again", quantile=0.9)
    found = table_source.baseline_thresholds(spark, f"{folder}/again")
    row = [(found.record, found.file_max, found.file_ratio, found.min_records)]
    shape_of = "record_threshold double, file_max_threshold double, file_ratio_threshold double, min_records int"
    return rounded(spark.createDataFrame(row, shape_of))


@query(
    """SELECT event_type AS source_file, count(*) AS records, count_if(user_id % 7 >= 4) AS malicious_records FROM events GROUP BY event_type"""
)
def stored_bundle_scores(spark, d):
    """A model trained on a label that one feature decides, stored, loaded and used on files: its labels are the rule's."""
    folder = shared_folder(spark, "bundle")
    rows = events(spark, d).select(
        F.col("event_id").cast("string").alias("frame_time"),
        (F.col("user_id") % 7).cast("string").alias("tcp_flags"),
        F.col("event_type").alias("mqtt_topic"),
        (F.col("user_id") % 7 >= 4).cast("int").cast("string").alias("Attack_label"),
        F.col("event_type").alias("source_file"),
    )
    options = jobs.TrainOptions(trees=TREES, min_records=10)
    jobs.train(spark, rows.drop("source_file"), folder, options)
    return jobs.score(spark, training.load_bundle(spark, folder), rows).summary.select("source_file", "records", "malicious_records")


@query(
    f"""WITH {S}, hours AS (SELECT w, count_if(value > 40) AS records, coalesce(max(p) FILTER (value > 40), 0) AS top,
    count_if(value > 40 AND p >= 0.5) AS attacks FROM s GROUP BY w)
  SELECT 'window_000000_' || strftime(w, '%Y%m%d_%H%M%S') || '.json' AS _id, records::INT AS record_count, attacks::INT AS attack_records,
    round(top, 6) AS max_attack_probability, (records >= 10)::INT AS window_pred_label FROM hours"""
)
def windows_without_records(spark, d):
    """Documents of which many have no records: zeros and no alert."""
    rows = events(spark, d).withColumn("w", F.date_trunc("hour", "ts"))
    docs = shape.window_documents(rows, "w", ["event_id"], ["value"], window_seconds=HOUR, interface=F.lit("eth0"))
    kept = F.filter("records", lambda r: r["value"].cast("double") > 40)
    docs = docs.withColumn("records", kept).withColumn("record_count", F.size("records")).withColumn("origin_file", F.lit("f"))
    found = window_job.score_documents(docs, value_scorer, RULE, at=F.lit(AT)).predictions
    return rounded(found.select("_id", "record_count", "attack_records", "max_attack_probability", "window_pred_label"))
