import random

import pytest
from pyspark.sql import functions as F

from packetloom.contract import SOURCE_FILE, FeatureContract
from packetloom.operators import training
from packetloom.operators.summary import PROBABILITY
from packetloom.plans import jobs

TREES = training.TreeSettings(trees=3, depth=3, bins=32)


def packets(n=600, seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        attack = r.random() < 0.4
        rows.append(
            (
                f"t{i}",
                str(r.randint(0, 40) + (60 if attack else 0)) if r.random() > 0.05 else "",
                r.choice(["0x2", "0x10"]),
                r.choice(["GET", "POST", "N/A"]) if r.random() < 0.9 else f"rare{i}",
                "",
                "0",
                "1" if attack else "0",
                "DoS" if attack else "Normal",
            )
        )
    return rows


COLUMNS = "`frame.time` string, `tcp.len` string, `tcp.flags` string, `http.request.method` string, " \
    "`udp.port` string, `mbtcp.len` string, Attack_label string, Attack_type string"


@pytest.fixture(scope="module")
def raw(spark):
    rows = packets()
    return spark.createDataFrame(rows + rows[:50], COLUMNS)


@pytest.fixture(scope="module")
def trained(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bundle") / "model")
    options = jobs.TrainOptions(trees=TREES, threshold_strategy="f2", min_records=10, min_category_count=5)
    return jobs.train(spark, raw, path, options), path


def test_training_report(trained):
    result, _ = trained
    report = result.report.first()
    assert (report.original_rows, report.rows_after_drop_duplicates) == (650, 600)
    contract = result.bundle.contract
    assert contract.numeric_columns == ["tcp_len", "tcp_flags"] and contract.categorical_columns == ["http_request_method"]
    assert contract.dropped_identity_payload_columns == ["frame_time", "udp_port"]
    assert contract.dropped_constant_columns == ["mbtcp_len"]
    assert contract.evaluation_metrics["roc_auc"] > 0.95 and 0 < contract.record_threshold < 1
    assert contract.runtime["rows_total"] == 600 and contract.min_records == 10
    assert {r.label: r.rows for r in result.classes.collect()}.keys() == {0, 1}


def test_bundle_scores_the_same_after_loading(spark, raw, trained):
    result, path = trained
    loaded = training.load_bundle(spark, path)
    assert loaded.contract == result.bundle.contract
    text = raw.toDF(*[c.replace(".", "_") for c in raw.columns])
    a = [r[0] for r in result.bundle.score(text, ["frame_time"]).orderBy("frame_time").select(PROBABILITY).collect()]
    b = [r[0] for r in loaded.score(text, ["frame_time"]).orderBy("frame_time").select(PROBABILITY).collect()]
    assert a == pytest.approx(b) and all(0 <= p <= 1 for p in a)
    importance = spark.read.option("header", "true").csv(f"{path}/feature_importance").collect()
    assert importance[0].feature == "num__tcp_len"


def test_unknown_and_missing_columns_score(spark, trained):
    bundle = trained[0].bundle
    df = spark.createDataFrame([("95", "BREW"), ("3", None), ("x", "GET")], "tcp_len string, http_request_method string")
    rows = bundle.score(df, ["tcp_len"]).collect()
    assert [r[SOURCE_FILE] for r in rows] == ["unknown"] * 3
    found = {r.tcp_len: r[PROBABILITY] for r in rows}
    assert found["95"] > 0.5 > found["3"]


def test_no_python_runs_when_scoring(spark, raw, trained):
    text = raw.toDF(*[c.replace(".", "_") for c in raw.columns])
    plan = trained[0].bundle.score(text, ["frame_time"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("listed", [1000, 0])
def test_rare_categories(spark, monkeypatch, listed):
    monkeypatch.setattr(training, "LITERAL_CATEGORIES", listed)
    train = spark.createDataFrame([("hot",)] * 50 + [("warm",)] * 5 + [("r1",), ("r2",)], "c string")
    vocabulary = training.build_vocabulary(train, ["c"], 5)
    assert vocabulary.labels("c") == ["hot", "warm", training.RARE]
    df = spark.createDataFrame([("hot",), ("r1",), ("new",), ("warm",), ("r2",)], "c string")
    assert sorted(r.c for r in training.bucket_rare(df, vocabulary).collect()) == ["__RARE__", "__RARE__", "hot", "new", "warm"]


def test_one_hot_zeros_for_unknown(spark):
    from pyspark.ml import Pipeline

    vocabulary = training.Vocabulary({"c": ["a", "b"]}, None, {"c": 1})
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), (training.RARE, 3.0), ("?", 4.0), (None, 5.0)], "c string, n double")
    model = Pipeline(stages=training.feature_stages(["n"], ["c"], vocabulary)).fit(df)
    vectors = [r.features.toArray().tolist() for r in model.transform(df).collect()]
    assert vectors == [[1, 1, 0, 0], [2, 0, 1, 0], [3, 0, 0, 1], [4, 0, 0, 0], [5, 0, 0, 0]]
    assert len(training.feature_names(["n"], ["c"], vocabulary)) == 4


def test_categories_beyond_the_most_frequent_share_one_feature(spark):
    df = spark.createDataFrame([("a",)] * 9 + [("b",)] * 8 + [("c",)] * 7 + [("d",)] * 2, "c string")
    vocabulary = training.build_vocabulary(df, ["c"], 5, max_categories=2)
    assert vocabulary.frequent == {"c": ["a", "b"]} and vocabulary.rare_counts == {"c": 2}
    counts = {r.c: r["count"] for r in training.bucket_rare(df, vocabulary).groupBy("c").count().collect()}
    assert counts == {"a": 9, "b": 8, training.RARE: 9}


def test_every_category_with_enough_rows_has_its_own_feature(spark):
    n = 10_050
    df = spark.range(2 * n + 3).select(F.when(F.col("id") < 2 * n, F.col("id") % n).otherwise(F.col("id")).cast("string").alias("c"))
    vocabulary = training.build_vocabulary(df, ["c"], 2)
    assert set(vocabulary.frequent["c"]) == {str(i) for i in range(n)} and vocabulary.rare_counts == {"c": 3}
    assert training.bucket_rare(df, vocabulary).where(F.col("c") != training.RARE).distinct().count() == n


def test_a_cap_on_categories_reaches_the_model(spark):
    typed = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1)] * 8, "c string, label int")
    contract = FeatureContract(feature_columns=["c"], numeric_columns=[], categorical_columns=["c"])
    for cap, labels in ((None, ["a", "b", "c"]), (1, ["a", training.RARE])):
        assert training.fit_model(typed, contract, TREES, 2, cap).vocabulary.labels("c") == labels


def test_split_is_a_partition_with_fixed_shares(spark):
    rare = F.when(F.col("id") % 400 == 0, 1).when(F.col("id") % 399 != 0, 0)
    rows = spark.range(20_000).withColumn("label", rare)
    for limit in (1_000_000, 3_000):
        df = training.with_split(rows, "label", "id", limit=limit)
        sizes = {(r.label, r["_split"]): r["count"] for r in df.groupBy("label", "_split").count().collect()}
        for label, n in ((r.label, r["count"]) for r in rows.groupBy("label").count().collect()):
            test = round(n * 0.2)
            validation = round((n - test) * 0.2)
            assert sizes[label, "test"] == test
            assert sizes[label, "validation"] == validation
            assert sizes[label, "train"] == n - test - validation


def test_medians(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None), (None, None)], "a double, b double")
    medians = training.column_medians(df, ["a", "b"])
    assert medians == {"a": 2.5, "b": None}
    assert training.fill_medians(df, medians).where("a = 2.5 AND b = 0").count() == 1


def test_no_features_is_an_error(spark):
    df = spark.createDataFrame([("1", "", "0"), ("1", "", "1")], "x string, y string, Attack_label string")
    with pytest.raises(ValueError, match="feature"):
        training.prepare_training_frame(df)


def test_user_function_scores_in_batches(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    scored = training.score_with_function(df, ["a", "b"], lambda f: (f["a"] + f["b"]) / 10, ["a"])
    assert [tuple(r) for r in scored.orderBy("a").collect()] == [(1.0, 0.3), (3.0, 0.7)]


def wide_rows(spark):
    """A hot category, many frequent ones, rare ones and a second column; the label hangs on both."""
    c = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 == 1, F.concat(F.lit("r"), "id")).otherwise((F.col("id") % 40).cast("string"))
    label = ((F.col("id") % 40 < 7) | (F.col("d") == "x")).cast("int")
    rows = spark.range(6000).select("id", c.alias("c"), F.when(F.col("id") % 5 == 0, "x").otherwise("y").alias("d"), (F.col("id") % 11 * 1.0).alias("n"))
    return rows.withColumn("label", label)


@pytest.mark.parametrize("listed", [1000, 0])
def test_places_equal_labels(spark, listed):
    rows = wide_rows(spark)
    vocabulary = training.build_vocabulary(rows, ["c", "d"], 20)
    split = training.build_vocabulary(rows, ["c", "d"], 20, limit=7)
    assert {c: vocabulary.labels(c) for c in "cd"} == {c: split.labels(c) for c in "cd"} and vocabulary.labels("c")[0] == "hot"
    more = rows.select("id", "c", "d", "n").union(spark.createDataFrame([(-1, "never seen", None, 0.0)], "id long, c string, d string, n double"))
    placed = training.with_places(more, split, ["c", "d"], listed=listed)
    assert placed.columns == [*more.columns, "c__place", "d__place"]
    for c in "cd":
        place = {v: i for i, v in enumerate(vocabulary.frequent[c])}
        for r in placed.select(c, f"{c}__place", "id").collect():
            rare = len(place) if r.id >= 0 else None
            assert r[1] == place.get(r[0], rare), r


def test_sparse_features_equal_the_one_hot_stages(spark):
    from pyspark.ml import Pipeline

    rows = wide_rows(spark)
    vocabulary = training.build_vocabulary(rows, ["c", "d"], 20)
    bucketed = training.bucket_rare(rows, vocabulary)
    model = Pipeline(stages=training.feature_stages(["n"], ["c", "d"], vocabulary)).fit(bucketed)
    a = {r.id: r.features.toArray().tolist() for r in model.transform(bucketed).collect()}
    offsets, length = training.place_offsets(["n"], ["c", "d"], vocabulary)
    placed = training.with_places(rows, vocabulary, ["c", "d"])
    b = placed.select("id", training.sparse_features(["n"], offsets, length).alias("features")).collect()
    assert {r.id: r.features.toArray().tolist() for r in b} == a
    assert length == len(training.feature_names(["n"], ["c", "d"], vocabulary))


def test_a_wide_vocabulary_scores_alike(spark, monkeypatch, tmp_path):
    """The same trees from one-hot stages and from lookups; loading lists no category on the driver."""
    contract = FeatureContract(feature_columns=["n", "c", "d"], numeric_columns=["n"], categorical_columns=["c", "d"])
    rows = wide_rows(spark).coalesce(1)
    narrow = training.fit_model(rows, contract, TREES, 20)
    monkeypatch.setattr(training, "ONE_HOT_LABELS", 3)
    wide = training.fit_model(rows, contract, TREES, 20)
    assert wide.is_wide and not narrow.is_wide

    def scores(model):
        found = model.score(rows, ["id"])
        assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
        return {r.id: r[PROBABILITY] for r in found.collect()}

    assert scores(wide) == pytest.approx(scores(narrow))
    named = [{r.feature: r.importance for r in m.importances(spark).collect()} for m in (wide, narrow)]
    assert named[0] == pytest.approx(named[1]) and len(named[0]) == len(training.feature_names(["n"], ["c", "d"], wide.vocabulary))
    training.save_bundle(training.Bundle(contract.with_values(medians=wide.medians), wide), str(tmp_path / "b"), spark)
    monkeypatch.setattr(training.StoredValues, "__getitem__", lambda *_: pytest.fail("a value list reached the driver"))
    loaded = training.load_bundle(spark, str(tmp_path / "b")).model
    assert scores(loaded) == pytest.approx(scores(wide))


def test_distinct_by_digest(spark):
    """Hot rows, nulls that change places, and digests that collide."""
    rows = [("a", None)] * 500 + [(None, "a")] * 3 + [("b", "c"), ("c", "b"), (None, None), (None, None)] + [(f"x{i}", "y") for i in range(50)]
    df = spark.createDataFrame(rows, "p string, q string")
    for digest in (training.row_digest, lambda _: F.lit(1), lambda columns: F.length(F.coalesce(columns[0], F.lit("")))):
        found, n = training.distinct_by_digest(df, digest)
        assert n == len(rows) and sorted(map(str, found.collect())) == sorted({str(r) for r in df.collect()})
    unique = spark.range(1000).select("id", F.repeat(F.lit("payload"), 50).alias("text"))
    plan = training.distinct_by_digest(unique)[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_raw_rows_are_parsed_once(spark, raw, monkeypatch):
    """The contract counts all rows without a pass of its own over the input."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    names = [c.replace(".", "_") for c in raw.columns]
    passed = raw.toDF(*names).mapInArrow(counted, ", ".join(f"{n} string" for n in names))
    _, contract = training.prepare_training_frame(passed)
    assert (contract.original_rows, contract.rows_after_drop_duplicates) == (650, 600) and reads.value == 650


def test_split_joins_nothing_by_label_alone(spark):
    """Such a join brings all rows of a label together in one task."""
    rows = [(i, None if i % 11 == 0 else int(i % 5 == 0)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, label int").repartition(3)
    large = training.with_split(df, "label", "id", limit=100)
    assert {tuple(r) for r in large.collect()} == {tuple(r) for r in training.with_split(df, "label", "id").collect()}
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 1 and "_range" in joins[0]


def test_vectors_are_spread_by_what_the_learner_keeps(spark):
    vectors = spark.range(20_000).coalesce(1)
    sizes = [len(p) for p in training.spread_vectors(vectors, 100, 1 << 20).rdd.glom().collect()]
    row = training.TREE_ROW_BYTES + 100 * training.TREE_CELL_BYTES
    assert sum(sizes) == 20_000 and max(sizes) * row <= 1.2 * (1 << 20)
    assert training.spread_vectors(vectors, 100).rdd.getNumPartitions() == 1
