import json

import pytest
from pyspark.sql import functions as F

from packetloom.contract import Thresholds
from packetloom.operators import training
from packetloom.plans import jobs
from packetloom.sinks.tables import read_upserted, run_folders
from packetloom.sources.tables import baseline_thresholds
from test_training import packets

HEADER = "frame.time,tcp.len,tcp.flags,http.request.method,udp.port,mbtcp.len,Attack_label,Attack_type"
OPTIONS = jobs.TrainOptions(trees=training.TreeSettings(trees=2, depth=3, bins=32), min_records=5, min_category_count=5)


def write_csv(path, rows, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *[",".join(r) for r in rows]]) + "\n")


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    rows = packets(500)
    write_csv(root / "train.csv", rows)
    attacks = [r for r in rows if r[6] == "1"]
    benign = [r for r in rows if r[6] == "0"]
    write_csv(root / "local" / "attack one.csv", [r[:6] for r in attacks[:60]], HEADER.rsplit(",", 2)[0])
    write_csv(root / "local" / "benign.csv", [r[:6] for r in benign[:80]], HEADER.rsplit(",", 2)[0])
    (root / "local" / "empty.csv").write_text("")
    write_csv(root / "good" / "b1.csv", [r[:6] for r in benign[:80]], HEADER.rsplit(",", 2)[0])
    write_csv(root / "good" / "b2.csv", [r[:6] for r in benign[80:160]], HEADER.rsplit(",", 2)[0])
    return root


@pytest.fixture(scope="module")
def finished(spark, data):
    return jobs.run(spark, str(data / "train.csv"), str(data / "local"), str(data / "out"), OPTIONS)


@pytest.fixture(scope="module")
def bundle(spark, data, finished):
    return training.load_bundle(spark, str(data / "out" / "model"))


def test_run(spark, data, finished):
    labels = {r.source_file: r for r in finished["summary"].collect()}
    assert labels["attack one.csv"].file_pred_label == 1 and labels["benign.csv"].file_pred_label == 0
    assert labels["attack one.csv"].records == 60
    status = {r.source_file: (r.rows, r.status) for r in finished["extract_report"].collect()}
    assert status == {"attack one.csv": (60, "ok"), "benign.csv": (80, "ok"), "empty.csv": (0, "failed")}
    stored = spark.read.option("header", "true").csv(str(data / "out" / "scored" / "predictions"))
    assert stored.count() == 140 and {"frame_time", "tcp_flags", "http_request_method"} <= set(stored.columns)
    assert finished["distribution"].first()["count"] == 140
    report = {r["column"]: r for r in finished["comparison"].collect()}
    assert report["tcp_len"].present_in_both and report["Attack_label"].local_null_ratio == 1.0
    assert ("local_all_null", "Attack_label") in {tuple(r) for r in finished["drift_lists"].collect()}


def test_replay(spark, data, bundle):
    out = str(data / "replayed")
    result = jobs.replay(spark, bundle, str(data / "local"), out)
    rows = {r.interface: r for r in result.summary.collect()}
    assert {n: (r.window_id, r.records, r.label_text) for n, r in rows.items()} == {
        "attack one.csv": (1, 60, "ATTACK"),
        "benign.csv": (2, 80, "BENIGN"),
        "empty.csv": (3, 0, "BENIGN"),
    }
    assert rows["empty.csv"].max_attack_probability == 0.0
    assert "dns_qry_name" in rows["benign.csv"].unsupported_tshark_fields
    indexes = sorted(r.record_index for r in result.predictions.where("window_id = 1").collect())
    assert indexes == list(range(60))
    first = result.predictions.where("window_id = 1 AND record_index = 0").first()
    assert first.frame_time == min(
        (r.frame_time for r in result.predictions.where("window_id = 1").collect()), key=lambda t: int(t[1:])
    )
    assert spark.read.option("header", "true").csv(f"{out}/window_predictions").count() == 3


def test_replay_options(spark, data, bundle):
    capped = jobs.replay(spark, bundle, str(data / "local"), rows_per_file=7, max_files=2, include_metadata=False)
    assert sorted((r.window_id, r.records) for r in capped.summary.collect()) == [(1, 7), (2, 7)]
    assert capped.predictions.columns == ["window_id", "record_index", "pred_proba_attack", "pred_label"]
    some = jobs.replay(spark, bundle, str(data / "local"), predicate="http_request_method = 'GET'")
    assert 0 < sum(r.records for r in some.summary.collect()) < 140


def test_calibration_on_benign_files(spark, data, bundle):
    out = str(data / "calibrated")
    row = jobs.calibrate_on_benign(spark, bundle, str(data / "good"), out).first()
    assert (row.windows_total, row.windows_used) == (2, 2) and row.file_ratio_threshold >= 0.4
    stored = spark.read.option("header", "true").csv(f"{out}/baseline_windows")
    assert {r.window_pred_label for r in stored.collect()} == {"0"}
    loaded = baseline_thresholds(spark, f"{out}/baseline")
    assert loaded.min_records == 5 and loaded.file_ratio == pytest.approx(row.file_ratio_threshold)
    again = jobs.replay(spark, bundle, str(data / "local"), baseline_path=f"{out}/baseline")
    assert again.summary.first().file_ratio_threshold == pytest.approx(row.file_ratio_threshold)
    assert baseline_thresholds(spark, None) is None


def test_stream_with_a_model(spark, data, bundle):
    live = data / "live"
    live.mkdir()
    names = HEADER.split(",")[:6]
    attacks = [dict(zip(names, r)) for r in packets(300) if r[6] == "1"][:20]
    for key, records in (("w1", attacks), ("w2", [])):
        body = {"stream_file": key, "window_end": "2026-01-01T00:00:00Z", "records": records}
        (live / f"{key}.json").write_text(json.dumps(body))
    folders = run_folders(str(data / "streamed"))
    jobs.stream(spark, bundle, str(live), folders, available_now=True, thresholds=Thresholds(min_records=3)).awaitTermination()
    rows = {r["_id"]: r for r in read_upserted(spark, folders.table("predictions")).collect()}
    assert rows["w1"].window_pred_label == 1 and rows["w1"].record_count == 20 and rows["w2"].record_count == 0
    assert read_upserted(spark, folders.table("alerts")).count() == 1
