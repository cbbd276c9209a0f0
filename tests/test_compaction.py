"""Tables whose old batches are folded into a base."""

import functools
import random

import pytest
from pyspark.sql import functions as F

from packetloom.contract import Thresholds
from packetloom.operators.summary import PROBABILITY
from packetloom.sinks import compaction, tables
from packetloom.streaming import packet_job, window_job
from test_streaming import document, scorer

RULE = Thresholds(record=0.5, file_max=0.5, file_ratio=0.4, min_records=1)


def rows_of(spark, path):
    return {(r["_id"], r.v) for r in tables.read_upserted(spark, path).collect()}


def test_readers_see_the_same_rows_from_few_folders(spark, tmp_path):
    path, expected, pick = str(tmp_path / "t"), {}, random.Random(1)
    for i in range(24):
        rows = {f"k{pick.randrange(40)}": i for _ in range(pick.randrange(6))}
        expected |= rows
        tables.upsert_batch(spark.createDataFrame(list(rows.items()), "_id string, v int").coalesce(1), path, i)
        if i % 8 == 7:
            before = rows_of(spark, path)
            assert tables.compact_upserted(spark, path, keep_open=3) == compaction.Manifest(i // 8 + 1, i - 3)
            assert rows_of(spark, path) == before == set(expected.items())
    # The batches that the last compaction folded go with the next one; all older ones and their bases are gone.
    assert compaction.batches(spark, path) == list(range(13, 24))
    assert sorted(compaction.names(spark, f"{path}/_base")) == ["g2", "g3"]
    opened = {f.split(path)[1].split("/")[1] for f in tables.read_upserted(spark, path).inputFiles()}
    assert opened <= {"_base", *(f"batch_id={i}" for i in range(21, 24))}
    assert compaction.read_table(spark, path).select("_id").distinct().count() == len(expected)
    with pytest.raises(ValueError, match="in the base"):
        tables.upsert_batch(spark.createDataFrame([("k", 1)], "_id string, v int"), path, 20)
    # The newest batches may be written again.
    tables.upsert_batch(spark.createDataFrame([("k1", 99)], "_id string, v int"), path, 23)
    assert ("k1", 99) in rows_of(spark, path)
    plan = tables.read_upserted(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "Exchange hashpartitioning" in plan and "BroadcastHashJoin" in plan


def test_a_compaction_that_dies_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for i in range(6):
        tables.upsert_batch(spark.createDataFrame([(f"k{i % 4}", i), ("all", i)], "_id string, v int"), path, i)
    before = rows_of(spark, path)
    with monkeypatch.context() as m:
        m.setattr(compaction, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            tables.compact_upserted(spark, path, keep_open=1)
    assert rows_of(spark, path) == before and compaction.manifest(spark, path) == compaction.Manifest()
    with monkeypatch.context() as m:
        m.setattr(compaction, "delete", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        tables.compact_upserted(spark, path, keep_open=1)
        assert rows_of(spark, path) == before
        tables.upsert_batch(spark.createDataFrame([("k9", 9)], "_id string, v int"), path, 6)
        with pytest.raises(RuntimeError):
            tables.compact_upserted(spark, path, keep_open=1)
    assert rows_of(spark, path) == before | {("k9", 9)}
    assert tables.compact_upserted(spark, path, keep_open=1) == compaction.Manifest(2, 5)


@pytest.mark.parametrize("every", [1000, 2])
def test_a_record_stream_with_compaction(spark, tmp_path, monkeypatch, every):
    """Windows whose rows come in many batches, before and after their counts were folded."""
    monkeypatch.setattr(packet_job, "compact_run", functools.partial(packet_job.compact_run, keep_open=1))
    rows = [(i, (i * 7 % 70), (i % 10) / 10) for i in range(140)]
    schema = "i int, s int, p double"
    for n in range(7):
        own = spark.createDataFrame(rows[n * 20 : n * 20 + 20], schema)
        own.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    scored = stream.select(F.timestamp_seconds("s").alias("ts"), F.col("p").alias(PROBABILITY))
    folders = tables.run_folders(str(tmp_path / "out"))
    packet_job.start_packet_scoring(
        scored, "ts", RULE, folders, watermark="10 seconds", available_now=True, compact_every=every
    ).awaitTermination()
    found = {r.window_start: r for r in tables.read_upserted(spark, folders.table("predictions")).collect()}
    assert len(found) == 2
    for (start, r), (low, high) in zip(sorted(found.items()), [(0, 30), (35, 65)]):
        own = [p for _, s, p in rows if low <= s < high]
        assert r.record_count == len(own) and r.attack_records == sum(p >= 0.5 for p in own)
        assert r.mean_attack_probability == pytest.approx(sum(own) / len(own))
    progress = packet_job.read_progress(spark, folders)
    assert progress.count() == 7 and progress.agg(F.sum("rows")).first()[0] == 140
    if every == 2:
        assert compaction.manifest(spark, folders.table("cells")).generation >= 2
        assert len(compaction.batches(spark, folders.table("cells"))) <= 4


def test_parts_of_a_window_before_and_after_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(window_job, "compact_run", functools.partial(window_job.compact_run, keep_open=1))
    folders = tables.run_folders(str(tmp_path / "out"))
    for i in range(6):
        document(tmp_path / "live", f"{i}.json", ["0.9"] * (i + 1), f"w_part{i + 1:04d}.json")
        query = window_job.start_window_scoring(
            spark, str(tmp_path / "live"), ["tcp.len"], scorer, RULE, folders, available_now=True, compact_every=2
        )
        query.awaitTermination()
        (row,) = tables.read_upserted(spark, folders.table("predictions")).collect()
        assert row.record_count == sum(range(i + 2))
    assert compaction.manifest(spark, folders.table("part_cells")).generation >= 1
