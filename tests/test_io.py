import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from packetloom.contract import PACKET_COLUMNS, spark_names
from packetloom.plans import queries
from packetloom.sinks import tables
from packetloom.sources import csv as source
from packetloom.sources.tables import recent_rows
from packetloom.sources.windows import read_documents


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_read_csv(spark, tmp_path):
    write(tmp_path / "a.csv", '﻿ip.src , tcp.len,ip.src,"q,r"\nh1,0x1,dup,1\nh2,,dup,2\n')
    df = source.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["ip_src", "tcp_len", "q,r"]
    assert [tuple(r) for r in df.collect()] == [("h1", "0x1", "1"), ("h2", None, "2")]
    assert source.read_csv(spark, str(tmp_path / "a.csv"), sample_rows=1).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        source.read_csv(spark, str(tmp_path / "none.csv"))


def test_header_default(spark, tmp_path):
    write(tmp_path / "a.csv", "x.y,z\n")
    assert source.header_or_default(spark, str(tmp_path / "a.csv")) == ["x_y", "z"]
    assert source.header_or_default(spark, str(tmp_path / "none.csv")) == spark_names(PACKET_COLUMNS)
    assert source.header_or_default(spark, None) == spark_names(PACKET_COLUMNS)


@pytest.mark.parametrize("by_file", [64, 1])
def test_read_many(spark, tmp_path, monkeypatch, by_file):
    monkeypatch.setattr(source, "HEADERS_BY_FILE", by_file)
    write(tmp_path / "b.csv", "x,y\n1,2\n3,4\n")
    write(tmp_path / "a b+c.csv", "y,z\n5,6\n")
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "sub" / "c.csv", "x,y\n7,8\n")
    write(tmp_path / "note.txt", "x,y\n9,9\n")
    rows = {(r.source_file, r.x, r.y, r.z) for r in source.read_many(spark, str(tmp_path)).collect()}
    assert rows == {("b.csv", "1", "2", None), ("b.csv", "3", "4", None), ("a b+c.csv", None, "5", "6")}
    assert source.read_many(spark, str(tmp_path), recursive=True).count() == 4
    assert source.read_many(spark, str(tmp_path), max_files=1).count() == 1
    ordered = source.read_many(spark, str(tmp_path), file_order=True).orderBy(*source.FILE_ORDER)
    assert [r.y for r in ordered.collect()] == ["5", "2", "4"]
    with pytest.raises(FileNotFoundError):
        source.read_many(spark, str(tmp_path), pattern="*.pcap")


def test_window_csv(spark, tmp_path):
    write(tmp_path / "w.csv", "tcp.len,other\n3,x\n")
    write(tmp_path / "empty.csv", "")
    assert [tuple(r) for r in source.read_window_csv(spark, str(tmp_path / "w.csv"), ["tcp.len", "udp.port"]).collect()] == [("3", "")]
    empty = source.read_window_csv(spark, str(tmp_path / "empty.csv"), ["tcp.len", "udp.port"])
    assert empty.columns == ["tcp_len", "udp_port"] and empty.count() == 0


def test_ingest_goes_on_after_bad_files(spark, tmp_path):
    write(tmp_path / "good.csv", "tcp.len,Attack_label\n1,1\n2,0\n")
    write(tmp_path / "ragged.csv", "tcp.len,x\n1,2\n3,4,5,6\n")
    write(tmp_path / "other.csv", "p,q\n1,2\n")
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "bare.csv", "tcp.len,x\n")
    rows, report = source.ingest(spark, str(tmp_path), ["tcp.len", "udp.port", "Attack_label"])
    status = {r.source_file: (r.rows, r.corrupt_rows, r.status) for r in report.collect()}
    assert status == {
        "good.csv": (2, 0, "ok"),
        "ragged.csv": (1, 1, "partial"),
        "other.csv": (0, 0, "failed"),
        "empty.csv": (0, 0, "failed"),
        "bare.csv": (0, 0, "ok"),
    }
    found = sorted((r.source_file, r.tcp_len, r.udp_port, r.Attack_label) for r in rows.collect())
    assert found == [("good.csv", "1", "", ""), ("good.csv", "2", "", ""), ("ragged.csv", "1", "", "")]


def test_ingest_without_any_usable_file(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv", "wt") as f:
        f.write("x\n1\n")
    rows, report = source.ingest(spark, str(tmp_path), ["tcp.len"])
    assert rows.count() == 0 and [r.status for r in report.collect()] == ["failed"]


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")

    def batch(rows):
        return spark.createDataFrame(rows, "_id string, v int, created_at string")

    tables.upsert_batch(batch([("a", 1, "t1"), ("b", 1, "t1")]), path, 0)
    tables.upsert_batch(batch([("a", 2, "t2"), ("c", 2, "t3")]), path, 1)
    tables.upsert_batch(batch([("a", 1, "t1"), ("b", 1, "t1")]), path, 0)  # replay of an old batch
    tables.upsert_batch(batch([]), path, 2)
    assert {(r["_id"], r.v) for r in tables.read_upserted(spark, path).collect()} == {("a", 2), ("b", 1), ("c", 2)}
    assert spark.read.parquet(path).count() == 4
    newest = recent_rows(spark, path, 2)
    assert newest.columns == ["v", "created_at"] and [r.created_at for r in newest.collect()] == ["t3", "t2"]
    with pytest.raises(Exception, match="has no _id"):
        tables.upsert_batch(batch([(None, 1, "t")]), path, 3)


def test_append_summary_blanks_and_order(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, None)], "b int, a string")
    tables.append_summary(df, path, ["a", "b", "c"])
    tables.append_summary(df, path, ["a", "b", "c"])
    back = spark.read.option("header", "true").csv(path)
    assert back.columns == ["a", "b", "c"] and back.count() == 2


def test_documents_are_single_files(spark, tmp_path):
    df = spark.range(5).select(F.concat(F.lit("k"), "id").alias("stream_file"), F.lit(None).cast("string").alias("n"))
    tables.write_documents(df, str(tmp_path / "d"))
    # A partition without rows may leave a file of zero bytes, which readers skip.
    files = [f for f in (tmp_path / "d").glob("*.json") if f.stat().st_size]
    assert len(files) == 5 and "n" in json.loads(files[0].read_text())


def test_small_documents_share_files(spark, tmp_path):
    df = spark.range(500).select(F.format_string("k%d", "id").alias("stream_file"), F.lit(1).alias("record_count"))
    tables.write_documents(df, str(tmp_path / "d"), documents_per_file=100)
    files = [f for f in (tmp_path / "d").glob("*.json") if f.stat().st_size]
    assert len(files) <= 2 * spark.sparkContext.defaultParallelism
    assert max(len(f.read_text().splitlines()) for f in files) <= 100
    found = read_documents(spark, str(tmp_path / "d"), ["a"], multi_line=False)
    assert {r.stream_file for r in found.collect()} == {f"k{i}" for i in range(500)}


def test_parts_of_windows_do_not_make_a_file_each(spark, tmp_path, monkeypatch):
    rows = spark.range(3000).select(
        F.col("id").alias("event_id"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 5)).alias("ts"),
        (F.col("id") % 97 * 1.5).alias("value"),
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    folders = []
    monkeypatch.setattr(queries, "shared_folder", lambda spark, purpose: folders.append(str(tmp_path / f"{purpose}{len(folders)}")) or folders[-1])
    split = queries.QUERIES["window_labels_split_documents"](spark, str(tmp_path)).collect()
    assert len(list(tmp_path.glob("live0/*.json"))) <= 2 * spark.sparkContext.defaultParallelism
    whole = queries.QUERIES["batch_window_scoring"](spark, str(tmp_path)).collect()
    assert len(split) == 5 and sorted(split) == sorted(whole)


def test_run_folders():
    assert tables.run_folders("/x/").table("alerts") == "/x/current/alerts"
    assert tables.run_folders("/x", fresh=True).root != tables.run_folders("/x", fresh=True).root


def test_table_formats(spark, tmp_path):
    df = spark.range(3)
    tables.write_table(df, str(tmp_path / "c"))
    tables.write_table(df, str(tmp_path / "p"), file_format="parquet")
    tables.append_predictions(df, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 6
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_heads_of_many_files(spark, tmp_path):
    """Files with huge tails, odd names, long headers, other line ends, compression and nothing at all."""
    names = ["a.csv", "b c+%41.csv", "ü.csv", "long.csv", "empty.csv", "cr.csv"]
    long = ",".join(f"c{i}" for i in range(9000))
    for name, text in zip(names, ["x,y\n1,2\n", "x\n", "é,y", long + "\n1\n", "", "p,q\r\n1,2\r\n"]):
        (tmp_path / name).write_bytes(text.encode())
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("g,h\n1,2\n")
    with open(tmp_path / "a.csv", "r+b") as f:
        f.truncate(8 << 30)  # a sparse file, which takes no room and would take long to read whole
    listed = source.list_files(spark, str(tmp_path), "*.csv*", with_empty=True)
    found = {r["path"].rsplit("/", 1)[1]: r.line for r in source.first_lines(listed).collect()}
    assert found == dict(zip(names, ["x,y", "x", "é,y", long, "", "p,q"])) | {"z.csv.gz": "g,h"}


def test_headers_where_only_spark_opens_files(spark, tmp_path, monkeypatch):
    for i in range(5):
        write(tmp_path / f"f{i}.csv", f"a,b{i % 2}\n1,2\n")
    monkeypatch.setattr(source, "HEADERS_BY_FILE", 0)
    expected = source.file_headers(spark, str(tmp_path), "*.csv")
    assert {h: len(paths) for h, paths in expected.items()} == {("a", "b0"): 3, ("a", "b1"): 2}
    heads = source.first_lines
    closed = lambda listed: heads(listed).withColumn("line", F.when(~F.col("path").rlike("f[12]"), F.col("line")))
    monkeypatch.setattr(source, "first_lines", closed)
    assert source.file_headers(spark, str(tmp_path), "*.csv") == expected


def test_first_rows_are_the_same_whatever_the_splits(spark, tmp_path):
    write(tmp_path / "a.csv", "i,t\n" + "".join(f"{i},{'x' * (i % 90)}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "10000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = source.read_csv(spark, str(tmp_path / "a.csv"), sample_rows=700).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [int(r.i) for r in rows] == list(range(700)) and list(rows[0].asDict()) == ["i", "t"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_in_files_of_many_splits(spark, tmp_path, monkeypatch, end):
    """Records over many lines and splits, doubled quotes, empty fields and lines; the one-task reader says the same."""
    pick = random.Random(6)
    fields = ["a", 'say ""hi""', "x" * 300, "one\ntwo", "\n\n", ",", "", '""', "é\n,"]
    for name in ("a.csv", "b.csv"):
        rows = [[str(i), pick.choice(fields), "\n".join(pick.choices(fields, k=pick.randrange(4)))] for i in range(2000)]
        rows.append(["2000", "long", "line\n" * 20_000])
        body = end.join(",".join([r[0], f'"{r[1]}"', f'"{r[2]}"' if r[2] else ""]) for r in rows)
        (tmp_path / name).write_bytes(("i,f.x,g" + end + body + end + end + "7,short" + end).encode())
    names = source.spark_names(["i", "f.x", "g"])
    one_task = source._read(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")], ["i", "f.x", "g"], multiLine="true")
    expected = sorted(map(str, one_task.select(*names).collect()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size, split_bytes in ((before, source.SPLIT_BYTES), ("20000", 1000)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        monkeypatch.setattr(source, "SPLIT_BYTES", split_bytes)
        try:
            found = source.read_many(spark, str(tmp_path), multi_line=True, file_order=True)
            assert sorted(map(str, found.select(*names).collect())) == expected
            ordered = found.where("source_file = 'b.csv'").orderBy(*source.FILE_ORDER).select("i").collect()
            assert [int(r.i) for r in ordered] == [*range(2001), 7]
            rows, report = source.ingest(spark, str(tmp_path), ["i", "f.x"], multi_line=True)
            assert {(r.source_file, r.rows, r.corrupt_rows) for r in report.collect()} == {("a.csv", 2001, 1), ("b.csv", 2001, 1)}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_columns_behind_doubled_quotes(spark, tmp_path):
    """One column alone has the values that it has beside the others."""
    pick = random.Random(1)
    fields = ["a", 'say ""hi""', '""', ",", "", 'x""', '""x', '"""",']
    lines = [f'{i},"{pick.choice(fields)}","{pick.choice(fields)}",{i}' for i in range(500)]
    write(tmp_path / "a.csv", "\n".join(["i,f,g,h", *lines]) + "\n")
    rows = source.read_csv(spark, str(tmp_path / "a.csv"))
    assert [r.h for r in rows.select("h").collect()] == [str(i) for i in range(500)] and rows.where("i = h").count() == 500
