import json

import pytest
from pyspark.sql import functions as F

from packetloom.contract import Thresholds
from packetloom.functions.text import parse_numeric
from packetloom.operators.summary import PROBABILITY
from packetloom.sinks.tables import read_upserted, run_folders
from packetloom.sources.windows import document_schema, read_documents
from packetloom.streaming import packet_job, window_job

RULE = Thresholds(0.5, 0.5, 0.4, 2)


def scorer(records, keep):
    return records.select(*keep, parse_numeric("tcp_len").alias(PROBABILITY))


def document(folder, name, values, key="", **fields):
    body = {
        "window_id": 1,
        "window_start": "2026-01-01T00:00:00+00:00",
        "window_end": "2026-01-01T00:00:30+00:00",
        "interface": "wifi0",
        "source_path": "live_capture",
        "stream_file": key,
        "stream_json_path": f"/live/{name}",
        "window_seconds": 30,
        "record_count": len(values),
        "capture_filter": "",
        "display_filter": "",
        "unsupported_tshark_fields": ["x"],
        "records": [{"tcp.len": v} for v in values],
        **fields,
    }
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(body, indent=2))


def test_schema_keeps_the_file_path():
    assert "stream_json_path" in document_schema(["a.b"]).names


def test_stream_tables(spark, tmp_path):
    live = tmp_path / "live"
    document(live, "w1.json", ["0.9", "0.8", "0.1"] + ["0.6"] * 30, "w1")
    document(live, "w2.json", [], "w2")
    document(live, "w3.json", ["0.9"], "w3")
    document(live, "w4.json", ["0.1", "", "0.2"], "")
    folders = run_folders(str(tmp_path / "out"))

    def run():
        query = window_job.start_window_scoring(
            spark, str(live), ["tcp.len"], scorer, RULE, folders, available_now=True, max_files_per_trigger=2
        )
        query.awaitTermination()
        assert query.exception() is None

    run()
    predictions = {r["_id"]: r for r in read_upserted(spark, folders.table("predictions")).collect()}
    assert set(predictions) == {"w1", "w2", "w3", "w4.json"}
    w1, w2 = predictions["w1"], predictions["w2"]
    assert (w1.record_count, w1.attack_records, w1.window_pred_label, w1.max_attack_probability) == (33, 32, 1, 0.9)
    assert w1.median_attack_probability == 0.6 and w1.detection_latency_seconds > 0
    assert (w2.record_count, w2.attack_record_ratio, w2.mean_attack_probability, w2.window_pred_label) == (0, 0.0, 0.0, 0)
    assert predictions["w3"].window_pred_label == 0  # too few records
    alerts = read_upserted(spark, folders.table("alerts")).collect()
    assert [(a["_id"], a.reason) for a in alerts] == [("w1", "window_pred_label=1")]
    windows = {r["_id"]: r for r in read_upserted(spark, folders.table("windows")).collect()}
    assert windows["w1"].record_preview_count == 25 and windows["w1"].records_truncated
    assert windows["w2"].record_preview == [] and windows["w4.json"].stream_json_path == "/live/w4.json"

    # A later document with the same key replaces the row as a whole.
    document(live, "w1b.json", ["0.1", "0.2"], "w1", window_end="2026-01-01T00:01:00+00:00")
    run()
    again = {r["_id"]: r for r in read_upserted(spark, folders.table("predictions")).collect()}
    assert again["w1"].record_count == 2 and again["w1"].window_pred_label == 0 and len(again) == 4


def test_two_documents_with_one_key_in_a_batch(spark, tmp_path):
    document(tmp_path / "d", "a.json", ["0.9"] * 5, "k")
    document(tmp_path / "d", "b.json", ["0.1"] * 3, "k", window_end="2026-01-01T00:02:00+00:00")
    docs = read_documents(spark, str(tmp_path / "d"), ["tcp.len"])
    for split in (False, True):
        tables = window_job.score_documents(docs, scorer, RULE, split=split)
        assert [(r["_id"], r.record_count) for r in tables.predictions.collect()] == [("k", 3)]
        assert [(r["_id"], r.record_count) for r in tables.windows.collect()] == [("k", 3)]
        assert tables.alerts.count() == 0


def test_empty_batch_is_skipped(spark, tmp_path):
    folders = run_folders(str(tmp_path / "out"))
    docs = spark.createDataFrame([], document_schema(["tcp.len"])).withColumn("origin_file", F.lit("f"))
    window_job.batch_writer(scorer, RULE, folders)(docs, 0)
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize("limit_split", [None, True])
def test_gapped_windows(spark, limit_split):
    rows = [(t, (t % 10) / 10) for t in range(0, 140)]
    df = spark.createDataFrame(rows, f"s int, {PROBABILITY} double").withColumn("ts", F.timestamp_seconds("s"))
    cells = packet_job.capture_cells(df, "ts")
    summary = packet_job.capture_summary(cells, RULE, window_seconds=30, split=limit_split).orderBy("window_start")
    found = [(r.window_start[-14:-6], r.window_end[-14:-6], r.records) for r in summary.collect()]
    assert found == [
        ("00:00:00", "00:00:30", 30),
        ("00:00:35", "00:01:05", 30),
        ("00:01:10", "00:01:40", 30),
        ("00:01:45", "00:02:15", 30),
    ]


def test_metrics_of_a_run(spark, tmp_path):
    document(tmp_path / "live", "w.json", ["0.9"] * 3, "w")
    folders = run_folders(str(tmp_path / "out"), fresh=True)
    query = window_job.start_window_scoring(spark, str(tmp_path / "live"), ["tcp.len"], scorer, RULE, folders, available_now=True)
    query.awaitTermination()
    metrics = packet_job.run_metrics(query)
    assert metrics and metrics[0]["rows"] >= 1


def test_parts_of_a_window_in_several_batches(spark, tmp_path):
    live = tmp_path / "live"
    folders = run_folders(str(tmp_path / "out"))

    def run():
        query = window_job.start_window_scoring(
            spark, str(live), ["tcp.len"], scorer, RULE, folders, available_now=True, max_files_per_trigger=1
        )
        query.awaitTermination()
        assert query.exception() is None
        tables = [read_upserted(spark, folders.table(t)).collect() for t in ("predictions", "windows")]
        return [{r["_id"]: r for r in rows} for rows in tables]

    document(live, "a.json", ["0.9"] * 6 + ["0.8"], "w_part0001.json")
    document(live, "b.json", ["0.1"] * 3, "w_part0002.json")
    document(live, "c.json", [], "w_part0003.json")
    document(live, "d.json", ["0.2"] * 3, "other.json")
    predictions, windows = run()
    assert set(predictions) == set(windows) == {"w.json", "other.json"}
    w = predictions["w.json"]
    assert (w.record_count, w.attack_records, w.window_pred_label, w.max_attack_probability) == (10, 7, 1, 0.9)
    assert w.median_attack_probability == pytest.approx(0.9) and w.mean_attack_probability == pytest.approx(0.65)
    assert windows["w.json"].record_count == 10 and predictions["other.json"].record_count == 3

    # A part that comes again replaces its own records, a further one adds its own.
    document(live, "e.json", ["0.1"] * 5, "w_part0002.json")
    document(live, "f.json", ["0.7"], "w_part0004.json")
    predictions, windows = run()
    assert (predictions["w.json"].record_count, predictions["w.json"].attack_records) == (13, 8)
    assert windows["w.json"].record_count == 13 and predictions["other.json"].record_count == 3
