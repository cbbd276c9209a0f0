"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import bpe, chat_format, decontamination, importance, near_duplicates, quality_rules, repeated_bytes, secrets
from packetloom.llm import centroid_clusters, source_divergence, token_files, toxicity, url_filter
from packetloom.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to the Python workers, once per application."""
    context = spark.sparkContext
    if any(f.endswith("/packetloom.zip") for f in context.listFiles):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(), "packetloom"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    context.addPyFile(archive)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function name."""

    @functools.wraps(f)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = prepared
    return prepared


def tokenizer_file(name: str) -> str:
    """A vocabulary file that is installed beside the library."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents").select("doc_id", "text"), complete=True)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )


# The conversation that the contract adds, and its rules.
ADDED_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = given.unionAll(spark.createDataFrame(ADDED_TURNS, given.schema))
    turns = turns.withColumn("parts", chat_format.text_part(F.col("text")))
    return chat_format.read_back(chat_format.format_turns(turns))


@query
def op6_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"))


@query
def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), folder)
    return token_files.id_checksums(token_files.read_token_files(spark, folder), "doc_id", "start", "n_tokens")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op11_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergences(table(spark, sf_dir, "documents"))


@query
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters.centroid_clusters(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


# ------------------------------------------------------------------ the same in SQL

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op3_minhash_dedup"] = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b
), component AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN component USING (doc_id)
"""

ORACLE["op5_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), controls AS (
    SELECT unnest(['\', '<|', '<s>', '</s>', '[INST]', '[/INST]']) AS c
), sized AS (
    SELECT t.*, length('<|turn|><|role|><|end|>') + length(role) + length(text)
        + (SELECT sum((length(t.role) - length(replace(t.role, c, '')) + length(t.text) - length(replace(t.text, c, ''))) // length(c)) FROM controls)
        AS chars
    FROM turns t
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLE["op8_url_filter"] = r"""
WITH rules(h, p, v) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), cut AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), best AS (
    SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
    FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
"""

BENCHMARK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE["op10_decontamination"] = f"""
WITH item_words AS (
    SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({LOWER}, '{BENCHMARK_WORD}') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
    FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
    SELECT doc_id, regexp_extract_all({LOWER}, '{BENCHMARK_WORD}') AS w FROM documents
), places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words CROSS JOIN (SELECT DISTINCT n FROM windows))
), found AS (
    SELECT doc_id, item, places.n, i FROM places JOIN windows ON windows.n = places.n AND windows.s = places.s
), hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op12_source_divergence"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), words AS (
    SELECT id, lang, source, unnest(w) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
    SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), groups AS (
    SELECT g.lang, g.source, coalesce(t.n, 0) AS total, v, s.n AS lang_total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes s USING (lang)
        LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) t USING (lang, source)
), dense AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + ((1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + v)::HUGEINT) AS p,
        1 + ((1000000000::HUGEINT * (k.n + 1)) // (lang_total + v)::HUGEINT) AS q
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pair_sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
        LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM dense WHERE n > 0 AND p > q
), placed AS (
    SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS place FROM pairs
    UNION ALL
    SELECT *, 'term' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS place FROM terms
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank FROM placed WHERE part = 'pair' OR place <= 200
"""


def _round(i: int) -> str:
    """One round of op13: the nearest centroid of each vector, then the floored means."""
    return f"""assigned{i} AS MATERIALIZED (
    SELECT id, min(list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT * 16 + c) AS best
    FROM kept CROSS JOIN centroids{i} GROUP BY id
), sums{i} AS (
    SELECT best % 16 AS c, place, sum(x) AS s, count(*) AS n
    FROM (SELECT best, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM assigned{i} JOIN kept USING (id)) GROUP BY ALL
), centroids{i + 1} AS MATERIALIZED (
    SELECT o.c, coalesce(m.w, o.w) AS w
    FROM centroids{i} o LEFT JOIN (SELECT c, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY place) AS w FROM sums{i} GROUP BY c) m USING (c)
)"""


ORACLE["op13_centroid_clusters"] = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id, sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS digest,
        list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY digest, v) - 1 AS c, v AS w FROM (SELECT digest, v FROM kept ORDER BY digest, v LIMIT 16)
), {", ".join(_round(i) for i in range(4))}
SELECT vec_id, (best % 16)::INTEGER AS cluster, (best // 16)::BIGINT AS distance,
    sum(best // 16) OVER (PARTITION BY best % 16)::BIGINT AS cluster_inertia, sum(best // 16) OVER ()::BIGINT AS inertia,
    sha256(list_aggregate(w, 'string_agg', ',')) AS centroid_sha256
FROM assigned3 JOIN kept USING (id) JOIN centroids3 ON c = best % 16
"""
