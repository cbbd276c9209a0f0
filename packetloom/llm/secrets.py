"""Secret scans with linking of credential parts, in DataFrame expressions alone.

Strong kinds (assigned values, access keys, long hex) are reported wherever
they stand. Weak ones are parts of credentials that mean little alone: a mixed
string that may be a secret, an account name, an endpoint. They are linked by
an interval join: a part reaches REACH code points to either side, and parts
of one text whose intervals overlap are in one scope. A weak secret is
reported if an access key or an account stands in its scope, and then the
endpoints in its scope are reported too. With ``complete``, as the query and
the pipeline ask for, assigned values and long hex are secrets of such a link
as well, and the accounts in the scope of a secret are reported.

Positions are code points, ends exclusive. Matches of a pattern are leftmost
and do not overlap. Null and empty texts have no spans. Repeated rows are
judged alike, null keys are keys like others, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.arrow import plain_names
from packetloom.session import materialise

# The strong kinds in the order in which they are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
MIN_ASSIGNED = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

ACCOUNT = r"""(?i:user(?:_?name)?|login|account(?:_?id)?|client_?id|(?:access_?)?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}"""
ENDPOINT = r"""(?:(?:https?|ftp|sftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\s"'<>]{4,}|(?i:host(?:_?name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:-]{4,})"""
MIXED = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
REACH = 200

KINDS = ("assign", "access", "hex", "secret", "endpoint", "account")
SPANS = "array<struct<start:int,rank:int,end:int>>"
SPAN_COLUMNS = ("_assign", "_access", "_hex", "_mixed", "_account", "_endpoint")


def spans_of(text: str, pattern: str, rank: int, keep=None) -> Column:
    """Spans of all matches of ``pattern`` for which ``keep`` holds.

    The pieces between the matches and the matches themselves alternate, so
    adding up their lengths gives the positions.
    """
    lengths = F.zip_with(
        F.split(F.col(text), pattern, -1),
        F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(
            F.char_length(gap).alias("gap"),
            F.char_length(match).alias("length"),
            (match.isNotNull() & (F.lit(True) if keep is None else keep(match))).alias("kept"),
        ),
    )
    added = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPANS).alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + F.coalesce(x["length"], F.lit(0))).alias("at"),
            F.when(
                x["kept"],
                F.concat(
                    F.coalesce(a["spans"], F.array().cast(SPANS)),
                    F.array(
                        F.struct(
                            (a["at"] + x["gap"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            (a["at"] + x["gap"] + x["length"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(a["spans"])
            .alias("spans"),
        ),
        lambda a: F.coalesce(a["spans"], F.array().cast(SPANS)),
    )
    # Most texts have no match; finding that out takes one search instead of two.
    return F.when(F.col(text).rlike(pattern), added).otherwise(F.array().cast(SPANS))


def none() -> Column:
    return F.array().cast(SPANS)


def credential_parts(docs: DataFrame, text: str = "text", complete: bool = False) -> DataFrame:
    """Add the spans of all strong and weak parts (SPAN_COLUMNS) and a digest of texts whose parts may be linked."""

    def long_enough(match: Column) -> Column:
        return F.char_length(F.regexp_extract(match, ASSIGN, 1)) >= MIN_ASSIGNED

    def mixed(match: Column) -> Column:
        return match.rlike("[0-9]") & match.rlike("[a-z]") & match.rlike("[A-Z]")

    found = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    found = found.withColumns(
        {
            "_assign": spans_of("_text", ASSIGN, 0, long_enough),
            "_access": spans_of("_text", ACCESS, 1),
            "_hex": spans_of("_text", HEX, 2),
            "_mixed": spans_of("_text", MIXED, 3, mixed),
        }
    )
    some = F.size("_mixed") + (F.size("_assign") + F.size("_hex") if complete else F.lit(0)) > 0
    found = found.withColumn("_account", F.when(some, spans_of("_text", ACCOUNT, 5)).otherwise(none()))
    linkable = some & (F.size("_access") + F.size("_account") > 0)
    return found.withColumns(
        {
            "_endpoint": F.when(linkable, spans_of("_text", ENDPOINT, 4)).otherwise(none()),
            "_digest": F.when(linkable, F.sha2("_text", 256)),
        }
    ).drop("_text")


def in_cells(parts: DataFrame, reach: int) -> DataFrame:
    """One row for each cell of REACH code points that a part, widened by ``reach``, touches."""
    first = F.floor((F.col("start") - reach) / REACH)
    last = F.floor((F.col("end") - 1 + reach) / REACH)
    return parts.withColumn("cell", F.explode(F.sequence(first, last)))


def in_scope(parts: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """The ``parts`` with one of ``others`` in their scope.

    Both sides meet in cells. A cell holds few parts, as parts of one kind do
    not overlap; a semi join gives each part once per cell, however many it meets.
    """
    a = in_cells(parts, REACH).alias("a")
    b = in_cells(others, 0).select(*[F.col(k).alias(f"o_{k}") for k in keys], "cell", "start", "end").alias("b")
    same = F.col("a.cell") == F.col("b.cell")
    for k in keys:
        same &= F.col(f"a.{k}").eqNullSafe(F.col(f"b.o_{k}"))
    near = (F.col("b.start") < F.col("a.end") + REACH) & (F.col("b.end") > F.col("a.start") - REACH)
    return a.join(b, same & near, "left_semi").drop("cell").distinct()


def linked_parts(found: DataFrame, keys: list[str], complete: bool = False) -> DataFrame:
    """Weak spans that are reported, one row for each text (``keys``) that has some."""

    def rows(*columns: str) -> DataFrame:
        spans = found.select(*keys, F.explode(F.concat(*[F.col(c) for c in columns])).alias("s"))
        return spans.select(*keys, "s.start", "s.rank", "s.end").distinct()

    parts = rows("_mixed", "_assign", "_hex") if complete else rows("_mixed")
    secrets = in_scope(parts, rows("_access", "_account"), keys)
    linked = secrets.where(F.col("rank") == 3).unionAll(in_scope(rows("_endpoint"), secrets, keys))
    if complete:
        linked = linked.unionAll(in_scope(rows("_account"), parts, keys))
    return (
        linked
        .groupBy(*keys)
        .agg(F.collect_set(F.struct("start", "rank", "end")).alias("_linked"))
    )


def free_of(spans: Column, strong: Column) -> Column:
    """The spans that overlap no strong one, which is reported itself."""
    return F.filter(spans, lambda s: ~F.exists(strong, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def with_secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", complete: bool = False) -> DataFrame:
    """Add ``_base`` and ``_spans``, the strong and all reported spans in order, to the rows of ``docs``.

    The parts are found once and written to the shared folder; only texts with
    parts that may be linked take part in the join.
    """
    found = credential_parts(docs, text, complete)
    strong = F.array_sort(F.concat("_assign", "_access", "_hex"))
    found = found.withColumn("_base", strong).withColumn("_mixed", free_of(F.col("_mixed"), F.col("_base")))
    found = materialise(found, "secret-parts")
    keys = [key, "_digest"]
    linkable = found.where(F.col("_digest").isNotNull())
    links = linked_parts(linkable, keys, complete).withColumnRenamed(key, "_link_key").withColumnRenamed("_digest", "_link_digest")
    same = F.col(key).eqNullSafe(F.col("_link_key")) & (F.col("_digest") == F.col("_link_digest"))
    joined = linkable.join(links, same, "left").drop("_link_key", "_link_digest")
    alone = found.where(F.col("_digest").isNull()).withColumn("_linked", none())
    every = alone.unionByName(joined)
    spans = F.array_sort(F.concat("_base", F.coalesce(F.col("_linked"), none())))
    return every.withColumn("_spans", spans).drop("_linked", "_digest", "_mixed", "_account", "_endpoint")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, key: str = "doc_id", text: str = "text", complete: bool = False) -> DataFrame:
    """For each row of ``docs``: numbers of strong spans, a digest of them, and all spans as text."""
    found = with_secret_spans(docs.select(key, text), key, text, complete)
    return found.select(
        key,
        F.size("_assign").cast("long").alias("n_assign"),
        F.size("_access").cast("long").alias("n_access"),
        F.size("_hex").cast("long").alias("n_hex"),
        F.sha2(span_text(F.col("_base")), 256).alias("base_sha256"),
        span_text(F.col("_spans")).alias("spans"),
    )


def redacted(
    docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]", complete: bool = False
) -> DataFrame:
    """``docs`` with each run of reported spans replaced by ``mark``; other texts, and nulls, stay as they are."""
    names = docs.columns
    docs, (key, text) = plain_names(docs, key, text)
    found = with_secret_spans(docs, key, text, complete)
    body = F.col(text)
    cut = F.aggregate(
        "_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"])
            .otherwise(F.concat(a["out"], F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))
            .alias("out"),
        ),
    )
    result = found.withColumn("_cut", F.when(F.size("_spans") > 0, cut))
    rest = F.concat(F.col("_cut.out"), F.substring(body, F.col("_cut.at") + 1, F.char_length(body)))
    kept = [F.when(F.size("_spans") > 0, rest).otherwise(body).alias(c) if c == text else F.col(c) for c in docs.columns]
    return result.select(*kept).toDF(*names)
