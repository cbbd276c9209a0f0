"""Training data, preprocessing, the boosted-tree model and its bundle."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.contract import (
    DEFAULT_MIN_RECORDS,
    DEFAULT_RATIO_THRESHOLD,
    DEFAULT_RECORD_THRESHOLD,
    IDENTITY_PAYLOAD_COLUMNS,
    SOURCE_FILE,
    FeatureContract,
    feature_columns,
    spark_names,
)
from packetloom.operators.distribution import ROWS_PER_TASK, exact_percentiles, join_null_safe, with_record_index
from packetloom.operators.evaluate import choose_threshold, evaluate, score_curve
from packetloom.operators.profile import NUMERIC_THRESHOLD, binary_labels, column_facts, prune_columns
from packetloom.operators.shape import align_to_contract, normalize_columns
from packetloom.operators.summary import PROBABILITY
from packetloom.operators.typing import type_columns
from packetloom.session import materialise, shared_folder

TARGET = "label"
ROW_KEY = "_row_key"
WEIGHT = "_weight"
RARE = "__RARE__"

MIN_CATEGORY_COUNT = 20  # fixed value: rarer categories share one feature
LITERAL_CATEGORIES = 1_000  # up to this many rare categories are listed in the plan
HOT_CATEGORIES = 100  # the most frequent categories, kept out of the lookups that shuffle
TREE_TASK_BYTES = 32 << 20  # binned rows of one partition of the tree learner
TREE_ROW_BYTES, TREE_CELL_BYTES = 64, 4  # what it keeps per row, and per row and feature
ONE_HOT_LABELS = 100_000  # up to this many categories of all columns are listed in the encoders; more stay a table

# Split shares in percent and seeds of the two nested splits.
TEST_PERCENT, VALIDATION_PERCENT, SPLIT_SEED = 20, 20, 42


@dataclass(frozen=True)
class TreeSettings:
    """Boosted trees; the defaults are fixed values."""

    trees: int = 350
    depth: int = 6
    step: float = 0.04
    row_share: float = 0.85
    column_share: str = "0.85"
    min_rows: int = 3
    bins: int = 256
    seed: int = 42


# -------------------------------------------------------------- training rows


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct on the raw text; equal rows combine before the shuffle."""
    return df.dropDuplicates()


def row_digest(columns: Sequence[str]) -> Column:
    """128 bits of a row; equal rows have equal ones, and rows with equal ones are compared."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


def distinct_by_digest(df: DataFrame, digest: Callable[[Sequence[str]], Column] = row_digest) -> tuple[DataFrame, int]:
    """The distinct rows of a wide table, and the number of all rows.

    The rows are written once. Their digests are counted, and only rows whose
    digest repeats are looked up, shuffled and compared as a whole: what moves
    follows the duplicates, not the payload. The number of all rows is that of
    the stored table, so the input is parsed once.
    """
    columns = df.columns
    stored = materialise(df.withColumn("_digest", digest(columns)), "rows")
    repeated = stored.groupBy("_digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_digest")
    repeated = materialise(repeated, "repeated-digests")
    single = stored.join(repeated, "_digest", "left_anti")
    several = stored.join(repeated, "_digest", "left_semi").dropDuplicates(columns)
    return single.unionByName(several).select(*columns), stored.count()


def prepare_training_frame(
    raw: DataFrame,
    *,
    keep_identity_payload: bool = False,
    numeric_threshold: float = NUMERIC_THRESHOLD,
    drop_duplicates: bool = True,
) -> tuple[DataFrame, FeatureContract]:
    """Typed features, label and a row key, with the contract that records every decision.

    The input is parsed once. The distinct rows are written; one scan of them decides all columns.
    """
    df = normalize_columns(raw)
    df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    original_rows = None
    if drop_duplicates:
        df, original_rows = distinct_by_digest(df)
    before_drops = feature_columns(df.columns)
    identity = set(spark_names(IDENTITY_PAYLOAD_COLUMNS)) if not keep_identity_payload else set()
    dropped = [c for c in before_drops if c in identity]
    candidates = [c for c in before_drops if c not in identity]
    # The row key covers all columns, so it is taken before any is dropped.
    keyed = df.withColumn(ROW_KEY, F.xxhash64(*df.columns).cast("string")).drop(*dropped)
    keyed = materialise(keyed, "training-rows")
    rows = keyed.count()
    labelled, label_source = binary_labels(keyed, TARGET)

    facts = column_facts(keyed, candidates)
    numeric, categorical, empty, constant = prune_columns(facts, numeric_threshold)
    used = [c for c in candidates if c in {*numeric, *categorical}]
    if not used:
        raise ValueError("no usable feature columns remain after preprocessing")
    contract = FeatureContract(
        feature_columns=used,
        numeric_columns=numeric,
        categorical_columns=categorical,
        original_rows=original_rows if original_rows is not None else rows,
        rows_after_drop_duplicates=rows,
        label_source=label_source,
        raw_columns=df.columns,
        dropped_identity_payload_columns=dropped,
        dropped_empty_columns=empty,
        dropped_constant_columns=constant,
        numeric_parse_ratios={f.name: f.numeric_ratio for f in facts},
        numeric_non_empty_counts={f.name: f.non_empty for f in facts},
    )
    return type_columns(labelled, numeric, used, keep=[ROW_KEY, TARGET]), contract


def split_order(key: Column, seed: int) -> Column:
    """What orders the rows of a class before they are split: a digest, the same in every run and on every cluster."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(seed).cast("string")))


def with_split(
    df: DataFrame, label: str, key: str, *, name: str = "_split", seed: int = SPLIT_SEED, limit: int = ROWS_PER_TASK
) -> DataFrame:
    """Name each row 'test' (20 %), 'validation' (20 % of the rest) or 'train', with exact shares within each label.

    The rows of a label are ranked by digest and cut at the rounded shares.
    Rows of large labels are ranked in ranges, so no task holds a whole label;
    a label's size comes with the ranks, since a join by label would bring its
    rows together again.
    """
    ordered = df.withColumn("_order", split_order(F.col(key), seed))
    ranked = with_record_index(ordered, [label], ["_order", key], name="_rank", total="_size", limit=limit)
    test = F.round(F.col("_size") * TEST_PERCENT / 100)
    validation = F.round((F.col("_size") - test) * VALIDATION_PERCENT / 100)
    split = F.when(F.col("_rank") < test, "test").when(F.col("_rank") < test + validation, "validation").otherwise("train")
    return ranked.withColumn(name, split).drop("_order", "_rank", "_size")


def class_weight(df: DataFrame, label: str = TARGET) -> DataFrame:
    """One row: pos, neg and the weight of a positive row, neg / pos, or 1.0 without positives."""
    counts = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return counts.withColumn("weight", F.when(F.col("pos") > 0, F.col("neg") / F.col("pos")).otherwise(F.lit(1.0)))


# -------------------------------------------------------------- preprocessing


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of the numeric columns, None where a column has no value."""
    return exact_percentiles(df.select(*columns), {c: (c, 0.5) for c in columns}) if columns else {}


def fill_medians(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Numeric nulls as the median; a column that never had a value becomes 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m if m is not None else 0.0)) for c, m in medians.items()})


def category_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, rows) for all categories; counts combine before the shuffle."""
    long = df.select(*columns).unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


class StoredValues(Mapping):
    """Categories of each column in the order of their places, read from the index when asked for."""

    def __init__(self, index: DataFrame, columns: Sequence[str]):
        self.index, self.columns, self.known = index, list(columns), {}

    def __getitem__(self, column: str) -> list[str]:
        if column not in self.columns:
            raise KeyError(column)
        if column not in self.known:
            own = self.index.where(F.col("column") == column).orderBy("place").select("value")
            self.known[column] = [r["value"] for r in own.collect()]
        return self.known[column]

    def __iter__(self):
        return iter(self.columns)

    def __len__(self) -> int:
        return len(self.columns)


@dataclass(frozen=True)
class Vocabulary:
    """Categories with a feature of their own, by falling frequency, and the table of rare ones.

    ``index`` numbers the former in each column from 0, as (column, value,
    place). ``frequent`` lists them, which is meant for vocabularies that fit
    the driver; ``sizes`` and ``rare_counts`` tell how many there are.
    """

    frequent: Mapping[str, list[str]]
    rare: DataFrame | None
    rare_counts: dict[str, int] = field(default_factory=dict)
    index: DataFrame | None = None
    sizes: dict[str, int] | None = None
    listed: dict[str, int] | None = None  # rows of the index, where it holds only some of the categories

    def labels(self, column: str) -> list[str]:
        return self.frequent[column] + ([RARE] if self.rare_counts.get(column) else [])

    def size(self, column: str) -> int:
        """Categories of a column with a feature of their own; the rare ones' feature stands behind these."""
        return self.sizes.get(column, 0) if self.sizes is not None else len(self.frequent[column])

    def width(self, column: str) -> int:
        return self.size(column) + bool(self.rare_counts.get(column))

    def entries(self, column: str) -> int:
        """Rows of a column's lookup."""
        return (self.listed or self.sizes or {}).get(column, 0) + self.rare_counts.get(column, 0)

    def hottest(self, column: str) -> list[str]:
        """The HOT_CATEGORIES most frequent categories."""
        if self.index is None:
            return self.frequent[column][:HOT_CATEGORIES]
        own = self.index.where((F.col("column") == column) & (F.col("place") < HOT_CATEGORIES))
        return [r["value"] for r in own.orderBy("place").collect()]

    def is_wide(self, columns: Sequence[str]) -> bool:
        return sum(self.width(c) for c in columns) > ONE_HOT_LABELS

    def lookup(self, column: str) -> DataFrame:
        """(value, place) of all categories of a column, the rare ones in the place behind the others."""
        own = self.index.where(F.col("column") == column).select("value", "place")
        if not self.rare_counts.get(column):
            return own
        rare = self.rare.where(F.col("column") == column).select("value", F.lit(self.size(column)).cast("long").alias("place"))
        return own.unionByName(rare)


def stored_vocabulary(index: DataFrame, rare: DataFrame, columns: Sequence[str]) -> Vocabulary:
    """The vocabulary of a stored index and rare table. One row per column reaches the driver."""

    def counts(table: DataFrame) -> dict[str, int]:
        return {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}

    return Vocabulary(StoredValues(index, columns), rare, counts(rare), index, counts(index))


def build_vocabulary(
    df: DataFrame,
    columns: Sequence[str],
    min_count: int = MIN_CATEGORY_COUNT,
    max_categories: int | None = None,
    *,
    limit: int = ROWS_PER_TASK,
) -> Vocabulary | None:
    """Split the categories at ``min_count`` rows and number those that have as many.

    They become model features; with ``max_categories`` only that many of each
    column, the most frequent ones. All others share one feature. Both may be
    many and stay tables; numbers are counted by ranges of the whole order.
    """
    if not columns:
        return None
    counted = materialise(category_frequencies(df, columns), "categories")
    kept = counted.where(F.col("rows") >= min_count).withColumn("_less", -F.col("rows"))
    numbered = with_record_index(kept, ["column"], ["_less", "value"], name="place", limit=limit)
    if max_categories is not None:
        numbered = numbered.where(F.col("place") < max_categories)
    index = materialise(numbered.select("column", "value", F.col("place").cast("long").alias("place")), "category-index")
    named = index.select("column", "value").withColumn("_kept", F.lit(True))
    rest = join_null_safe(counted, named, ["column", "value"], "left").where(F.col("_kept").isNull())
    rare = materialise(rest.select("column", "value"), "rare-categories")
    return stored_vocabulary(index, rare, columns)


def no_key(df: DataFrame) -> Column:
    """One of many keys that match no category, chosen by the row, so that no task gets all rows that need no lookup."""
    return F.concat(F.lit("\x01"), F.pmod(F.xxhash64(*df.columns), F.lit(4096)).cast("string"))


def bucket_rare(df: DataFrame, vocabulary: Vocabulary | None) -> DataFrame:
    """Replace rare categories seen in training by one common value; others stay.

    A short list of rare values becomes part of the plan. A long one is looked
    up in a join that Spark plans by size; rows with one of the hot categories
    are spread over many keys that match nothing, so no task gets them all.
    """
    for c, count in (vocabulary.rare_counts if vocabulary else {}).items():
        rare = vocabulary.rare.where(F.col("column") == c).select("value")
        if count <= LITERAL_CATEGORIES:
            values = [r["value"] for r in rare.collect()]
            df = df.withColumn(c, F.when(F.col(c).isin(values), F.lit(RARE)).otherwise(F.col(c)))
            continue
        hot = F.col(c).isin(vocabulary.hottest(c))
        found = rare.select(F.col("value").alias("_lookup"), F.lit(True).alias("_is_rare"))
        df = (
            df.withColumn("_lookup", F.when(hot, no_key(df)).otherwise(F.col(c)))
            .join(found, "_lookup", "left")
            .withColumn(c, F.when(F.col("_is_rare"), F.lit(RARE)).otherwise(F.col(c)))
            .drop("_lookup", "_is_rare")
        )
    return df


def with_places(df: DataFrame, vocabulary: Vocabulary, columns: Sequence[str], *, listed: int = LITERAL_CATEGORIES) -> DataFrame:
    """Add ``<column>__place``, the place of each category in its column, null where training has not seen it.

    A short lookup goes to all tasks. A long one is joined as Spark plans it by
    size, without the hottest categories: these, at most HOT_CATEGORIES, go to
    all tasks and their rows are spread, so no task gets a hot category whole.
    """
    for c in columns:
        found = vocabulary.lookup(c)
        place = f"{c}__place"
        keyed = found.withColumnsRenamed({"value": "_lookup", "place": place})
        if vocabulary.entries(c) <= listed:
            joined = df.withColumn("_lookup", F.col(c)).join(F.broadcast(keyed), "_lookup", "left")
            df = joined.drop("_lookup")
            continue
        hot = vocabulary.index.where((F.col("column") == c) & (F.col("place") < HOT_CATEGORIES))
        hot = hot.select(F.col("value").alias("_hot"), F.col("place").alias("_hot_place"))
        marked = df.withColumn("_hot", F.col(c)).join(F.broadcast(hot), "_hot", "left").drop("_hot")
        marked = marked.withColumn("_lookup", F.when(F.col("_hot_place").isNotNull(), no_key(df)).otherwise(F.col(c)))
        joined = marked.join(keyed, "_lookup", "left").withColumn(place, F.coalesce("_hot_place", place))
        df = joined.drop("_lookup", "_hot_place")
    return df


def place_offsets(numeric: Sequence[str], categorical: Sequence[str], vocabulary: Vocabulary) -> tuple[dict[str, int], int]:
    """The vector position of each categorical column's first place, and the length of the vector."""
    offsets, end = {}, len(numeric)
    for c in categorical:
        offsets[c], end = end, end + vocabulary.width(c)
    return offsets, end


def sparse_features(numeric: Sequence[str], offsets: Mapping[str, int], length: int) -> Column:
    """The feature vector from numeric columns and places: what the one-hot stages give, without a list of categories.

    Spark has no expression for a sparse vector; its JSON reader builds one.
    """
    places = F.filter(F.array(*[F.col(f"{c}__place") + o for c, o in offsets.items()]), lambda x: x.isNotNull())
    numbers = F.array(*[F.col(c).cast("double") for c in numeric]).cast("array<double>")
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(length).alias("size"),
        F.concat(F.array(*[F.lit(i).cast("long") for i in range(len(numeric))]).cast("array<bigint>"), places).alias("indices"),
        F.concat(numbers, F.transform(places, lambda _: F.lit(1.0))).alias("values"),
    )
    shape = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), shape)["v"]


def feature_stages(numeric: Sequence[str], categorical: Sequence[str], vocabulary: Vocabulary | None) -> list:
    """Index and one-hot stages and the assembler. Unknown categories become all zeros."""
    stages: list = []
    inputs = list(numeric)
    encoded = [c for c in categorical if vocabulary and vocabulary.labels(c)]
    if encoded:
        # One indexer per column: lists of several columns are padded with nulls to one length on their way to the JVM.
        stages += [
            StringIndexerModel.from_labels(vocabulary.labels(c), inputCol=c, outputCol=f"{c}__index", handleInvalid="keep")
            for c in encoded
        ]
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}__index" for c in encoded],
                outputCols=[f"{c}__onehot" for c in encoded],
                dropLast=True,
            )
        )
        inputs += [f"{c}__onehot" for c in encoded]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


def feature_names(numeric: Sequence[str], categorical: Sequence[str], vocabulary: Vocabulary | None) -> list[str]:
    """Names of the vector's positions: numeric columns, then column_category."""
    names = [f"num__{c}" for c in numeric]
    for c in categorical:
        names += [f"cat__{c}_{v}" for v in (vocabulary.labels(c) if vocabulary else [])]
    return names


# --------------------------------------------------------------------- model


@dataclass(frozen=True)
class FittedModel:
    """Preprocessing facts and the fitted stages.

    With a wide vocabulary the stages are the trees alone, and features come
    from lookups in the index.
    """

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float | None]
    vocabulary: Vocabulary | None
    stages: PipelineModel

    @property
    def trees(self):
        return self.stages.stages[-1]

    @property
    def is_wide(self) -> bool:
        return len(self.stages.stages) == 1

    def prepare(self, typed: DataFrame) -> DataFrame:
        filled = fill_medians(typed, self.medians)
        if not self.is_wide:
            return bucket_rare(filled, self.vocabulary)
        offsets, length = place_offsets(self.numeric, self.categorical, self.vocabulary)
        used = self.used_places()
        split = {c: offsets[c] for c in self.categorical if used[c]}
        # At most as many categories as the trees have nodes.
        placed = with_places(filled, self.used_vocabulary(used), list(split), listed=max(LITERAL_CATEGORIES, *map(len, used.values())))
        return placed.withColumn("features", sparse_features(self.numeric, split, length))

    def used_places(self) -> dict[str, list[int]]:
        """Per categorical column the places that some tree splits on."""
        offsets, _ = place_offsets(self.numeric, self.categorical, self.vocabulary)
        found = [int(i) for i in self.trees.featureImportances.indices]
        ends = {c: o + self.vocabulary.width(c) for c, o in offsets.items()}
        return {c: [i - o for i in found if o <= i < ends[c]] for c, o in offsets.items()}

    def used_vocabulary(self, used: Mapping[str, list[int]]) -> Vocabulary:
        """What scoring has to look up: categories that no tree splits on change no score."""
        v = self.vocabulary
        own = [(c, p) for c, places in used.items() for p in places if p < v.size(c)]
        named = F.broadcast(v.index.sparkSession.createDataFrame(own, "column string, place long"))
        index = v.index.join(named, ["column", "place"], "left_semi").select("column", "value", "place")
        rare_counts = {c: n for c, n in v.rare_counts.items() if v.size(c) in used[c]}
        listed = {c: sum(p < v.size(c) for p in places) for c, places in used.items()}
        return Vocabulary(StoredValues(index, list(used)), v.rare, rare_counts, index, v.sizes, listed)

    def score(self, typed: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The columns to keep and the probability of class 1. No Python runs in the tasks."""
        scored = self.stages.transform(self.prepare(typed))
        return scored.select(*keep, vector_to_array("probability")[1].alias(PROBABILITY))

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance), one row per vector position; only the positions of splits reach the driver."""
        found = self.trees.featureImportances
        own = [(int(i), float(x)) for i, x in zip(found.indices, found.values)]
        values = spark.createDataFrame(own, "position long, importance double")
        names = [(i, f"num__{c}") for i, c in enumerate(self.numeric)]
        offsets, _ = place_offsets(self.numeric, self.categorical, self.vocabulary) if self.vocabulary else ({}, 0)
        names += [
            (offsets[c] + self.vocabulary.size(c), f"cat__{c}_{RARE}")
            for c in self.categorical
            if self.vocabulary and self.vocabulary.rare_counts.get(c)
        ]
        named = spark.createDataFrame(names, "position long, feature string")
        if self.vocabulary:
            first = spark.createDataFrame(list(offsets.items()), "column string, first long")
            places = self.vocabulary.index.join(F.broadcast(first), "column")
            named = named.unionByName(
                places.select((F.col("first") + F.col("place")).alias("position"), F.concat(F.lit("cat__"), "column", F.lit("_"), "value").alias("feature"))
            )
        return named.join(values, "position", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def top_importances(importances: DataFrame, limit: int = 25) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), "feature").limit(limit)


def spread_vectors(vectors: DataFrame, width: int, task_bytes: int = TREE_TASK_BYTES) -> DataFrame:
    """The stored vectors in as many partitions as the tree learner's copy of them needs.

    The learner keeps a number per row and feature, while the stored table is
    packed many times smaller, so the files' bytes tell nothing about a task.
    A table that is small enough for one task stays as it is.
    """
    wanted = math.ceil(vectors.count() * (TREE_ROW_BYTES + TREE_CELL_BYTES * width) / task_bytes)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.repartition(max(wanted, cores)) if wanted > 1 else vectors


def fit_model(
    typed: DataFrame,
    contract: FeatureContract,
    settings: TreeSettings = TreeSettings(),
    min_category_count: int = MIN_CATEGORY_COUNT,
    max_categories: int | None = None,
) -> FittedModel:
    """Fit preprocessing and trees on typed rows with a label."""
    spark = typed.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        # Long boosting runs cut their lineage here.
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "boosting"))
    numeric, categorical = contract.numeric_columns, contract.categorical_columns
    medians = column_medians(typed, numeric)
    vocabulary = build_vocabulary(typed, categorical, min_category_count, max_categories)
    weight = class_weight(typed).first()["weight"]
    rows = fill_medians(typed, medians).withColumn(
        WEIGHT, F.when(F.col(TARGET) == 1, F.lit(float(weight) or 1.0)).otherwise(F.lit(1.0))
    )
    trees = GBTClassifier(
        labelCol=TARGET,
        featuresCol="features",
        weightCol=WEIGHT,
        maxIter=settings.trees,
        maxDepth=settings.depth,
        stepSize=settings.step,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=settings.column_share,
        minInstancesPerNode=settings.min_rows,
        maxBins=settings.bins,
        seed=settings.seed,
    )
    if vocabulary and vocabulary.is_wide(categorical):
        encoders = []
        offsets, length = place_offsets(numeric, categorical, vocabulary)
        placed = with_places(rows, vocabulary, categorical)
        encoded = placed.withColumn("features", sparse_features(numeric, offsets, length))
    else:
        bucketed = bucket_rare(rows, vocabulary)
        fitted = Pipeline(stages=feature_stages(numeric, categorical, vocabulary)).fit(bucketed)
        encoders, encoded = fitted.stages, fitted.transform(bucketed)
    # The trees pass over their input many times; all of it reads this compact table.
    vectors = materialise(encoded.select(TARGET, WEIGHT, "features"), "vectors")
    width = len(numeric) + sum(vocabulary.width(c) for c in categorical) if vocabulary else len(numeric)
    stages = PipelineModel(stages=[*encoders, trees.fit(spread_vectors(vectors, width))])
    return FittedModel(list(numeric), list(categorical), medians, vocabulary, stages)


@dataclass(frozen=True)
class Bundle:
    """All that scoring needs."""

    contract: FeatureContract
    model: FittedModel

    def score(self, raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Probability for raw text rows, with provenance and the columns to keep."""
        typed = align_to_contract(raw, self.contract, keep)
        kept = [c for c in keep if c in raw.columns and c != SOURCE_FILE]
        carried = [f"raw_{c}" if c in self.contract.feature_columns else c for c in kept]
        scored = self.model.score(typed, [SOURCE_FILE, *carried])
        return scored.select(SOURCE_FILE, *[F.col(a).alias(c) for a, c in zip(carried, kept)], PROBABILITY)


def fit_bundle(
    typed: DataFrame,
    contract: FeatureContract,
    *,
    settings: TreeSettings = TreeSettings(),
    min_category_count: int = MIN_CATEGORY_COUNT,
    max_categories: int | None = None,
    threshold_strategy: str = "fixed",
    fixed_threshold: float = DEFAULT_RECORD_THRESHOLD,
    min_precision: float = 0.0,
    file_max_threshold: float = DEFAULT_RECORD_THRESHOLD,
    file_ratio_threshold: float = DEFAULT_RATIO_THRESHOLD,
    min_records: int = DEFAULT_MIN_RECORDS,
) -> Bundle:
    """Tune the threshold on validation rows, measure on test rows, then fit on all rows.

    With the fixed strategy no threshold is tuned and its model is not fitted.
    """
    started = time.perf_counter()
    rows = materialise(with_split(typed, TARGET, ROW_KEY), "typed-rows")
    train, validation, test = (rows.where(F.col("_split") == s) for s in ("train", "validation", "test"))
    sizes = {r["_split"]: r["n"] for r in rows.groupBy("_split").agg(F.count(F.lit(1)).alias("n")).collect()}
    runtime: dict[str, float] = {
        "rows_total": sum(sizes.values()),
        "features_total": len(contract.feature_columns),
        "train_rows_threshold_model": sizes.get("train", 0),
        "validation_rows": sizes.get("validation", 0),
        "test_rows": sizes.get("test", 0),
    }

    def timed(name: str, action: Callable):
        begun = time.perf_counter()
        result = action()
        runtime[name] = time.perf_counter() - begun
        return result

    def fit(part: DataFrame) -> FittedModel:
        return fit_model(part, contract, settings, min_category_count, max_categories)

    threshold, threshold_meta = fixed_threshold, {}
    if threshold_strategy != "fixed":
        tuned = timed("threshold_model_fit_seconds", lambda: fit(train))
        scored = tuned.score(validation, [TARGET])

        def choose():
            curve = score_curve(scored, TARGET, PROBABILITY)
            return choose_threshold(curve, threshold_strategy, min_precision=min_precision).first().asDict()

        chosen = timed("validation_predict_seconds", choose)
        if chosen["threshold"] is not None:
            threshold = chosen.pop("threshold")
            threshold_meta = chosen

    measured = timed("eval_model_fit_seconds", lambda: fit(rows.where(F.col("_split") != "test")))
    scored_test = materialise(measured.score(test, [TARGET]), "scored-test")
    metrics = timed("test_predict_seconds", lambda: evaluate(scored_test, TARGET, PROBABILITY, threshold))
    runtime["test_predict_rows_per_second"] = runtime["test_rows"] / max(runtime["test_predict_seconds"], 1e-9)
    final = timed("final_model_fit_seconds", lambda: fit(rows))
    runtime["fit_bundle_seconds"] = time.perf_counter() - started
    return Bundle(
        contract.with_values(
            medians=final.medians,
            min_category_count=min_category_count,
            record_threshold=threshold,
            file_max_threshold=file_max_threshold,
            file_ratio_threshold=file_ratio_threshold,
            min_records=min_records,
            threshold_strategy=threshold_strategy,
            threshold_meta=threshold_meta,
            evaluation_metrics=metrics,
            runtime=runtime,
        ),
        final,
    )


# -------------------------------------------------------------------- storage


def save_bundle(bundle: Bundle, path: str, spark: SparkSession) -> None:
    """Fitted stages, contract, vocabulary and importances under one folder."""
    bundle.model.stages.write().overwrite().save(f"{path}/stages")
    spark.createDataFrame([(bundle.contract.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/contract"
    )
    vocabulary = bundle.model.vocabulary
    if vocabulary:
        vocabulary.index.write.mode("overwrite").parquet(f"{path}/frequent")
        vocabulary.rare.write.mode("overwrite").parquet(f"{path}/rare")
    importances = bundle.model.importances(spark)
    importances.orderBy(F.col("importance").desc(), "feature").coalesce(1).write.mode("overwrite").option(
        "header", "true"
    ).csv(f"{path}/feature_importance")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    contract = FeatureContract.from_json(spark.read.text(f"{path}/contract", wholetext=True).first()["value"].strip())
    vocabulary = None
    if contract.categorical_columns:
        tables = (spark.read.parquet(f"{path}/{name}") for name in ("frequent", "rare"))
        vocabulary = stored_vocabulary(*tables, contract.categorical_columns)
    model = FittedModel(
        contract.numeric_columns,
        contract.categorical_columns,
        contract.medians,
        vocabulary,
        PipelineModel.load(f"{path}/stages"),
    )
    return Bundle(contract, model)


# ------------------------------------------------------------- other scorers


def score_with_function(
    typed: DataFrame, columns: Sequence[str], function: Callable, keep: Sequence[str]
) -> DataFrame:
    """Score with a user's function from a pandas frame of features to probabilities, in Arrow batches."""

    @F.pandas_udf("double")
    def probability(features):
        import pandas as pd

        return pd.Series(function(features), dtype="float64")

    return typed.select(*keep, probability(F.struct(*columns)).alias(PROBABILITY))
