"""Exact length histogram of a corpus and what follows from it for every context limit.

Documents are encoded once; only (length, documents) pairs reach the shuffle, combined on the map
side, so a hot length costs nothing. Suffix sums over the distinct lengths then answer token totals,
quantiles and totals after truncation for *any* limit, because all three are constant or linear
between two neighbouring lengths. The sums run inside ranges of lengths first and over the
range totals after, so no task sees more than one range.

Null and empty texts count as documents of length 0 (plus ``extra``). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.word_tokens import word_tokens
from tallyloom.sources.workspace import stage

RANGE = 1024


def token_length(text: Column | str, path: str | None = None) -> Column:
    """Ids that a text encodes to."""

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = word_tokens(path)
        for texts in batches:
            yield pd.Series(list(encoder.lengths(texts.tolist())), dtype="int64")

    return lengths(text)


def length_histogram(docs: DataFrame, text: str = "text", extra: int = 0, path: str | None = None) -> DataFrame:
    """``n_tokens, docs``: how many documents encode to each length."""
    lengths = docs.select((token_length(text, path) + F.lit(extra)).alias("n_tokens"))
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """One row per length L with totals of the documents of at least L tokens, and totals truncated at L."""
    # Read twice below; without this, each reading would encode all documents.
    histogram = stage(histogram, "lengths")
    bucket = F.floor(F.col("n_tokens") / RANGE).alias("bucket")
    totals = (
        histogram.groupBy(bucket)
        .agg(F.sum("docs").alias("bucket_docs"), F.sum(F.col("n_tokens") * F.col("docs")).alias("bucket_tokens"))
        .withColumn("above", F.lit(0))
    )
    # One row per range of lengths: the longest text over RANGE, not the number of documents.
    later = Window.partitionBy("above").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("above")
    totals = totals.select(
        "bucket",
        F.coalesce(F.sum("bucket_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("bucket_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("bucket_docs").over(whole).alias("all_docs"),
        F.sum("bucket_tokens").over(whole).alias("all_tokens"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = histogram.select("n_tokens", "docs", bucket).join(totals, "bucket")
    rows = rows.select(
        "n_tokens",
        "docs",
        (F.sum("docs").over(inside) + F.col("later_docs")).alias("docs_at_least"),
        (F.sum(F.col("n_tokens") * F.col("docs")).over(inside) + F.col("later_tokens")).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    shorter = F.col("all_tokens") - F.col("tokens_at_least")
    at_most = F.col("all_docs") - F.col("docs_at_least") + F.col("docs")
    return rows.select(
        "n_tokens",
        "docs",
        "docs_at_least",
        "tokens_at_least",
        at_most.alias("docs_at_most"),
        (at_most / F.col("all_docs")).alias("quantile"),
        (shorter + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        "all_docs",
        "all_tokens",
    )


def truncated_totals(sums: DataFrame, limits: DataFrame, limit: str = "context") -> DataFrame:
    """Tokens that remain when every document is cut at ``limit``, for each row of ``limits``.

    The next length at or above a limit decides: documents below it stay whole, the others give
    ``limit`` tokens each. Limits are tagged onto the same ordered ranges as the lengths, so
    this is a last-value window, not a range join.
    """
    zero = F.lit(None).cast("long")
    lengths = sums.select(
        F.col("n_tokens").alias("at"), zero.alias("wanted"), "docs_at_least", "tokens_at_least", "all_tokens"
    )
    asked = limits.select(
        F.col(limit).cast("long").alias("at"),
        F.col(limit).cast("long").alias("wanted"),
        *[zero.alias(name) for name in ("docs_at_least", "tokens_at_least", "all_tokens")],
    )
    total = sums.agg(F.max("all_tokens").alias("corpus_tokens"))
    # Distinct lengths and limits only, never documents.
    ahead = Window.orderBy("at", F.col("wanted").isNull()).rowsBetween(0, Window.unboundedFollowing)
    rows = lengths.unionByName(asked).withColumns(
        {name: F.first(name, ignorenulls=True).over(ahead) for name in ("docs_at_least", "tokens_at_least")}
    )
    rows = rows.where(F.col("wanted").isNotNull()).crossJoin(F.broadcast(total))
    kept = F.coalesce("docs_at_least", F.lit(0)), F.coalesce("tokens_at_least", F.lit(0))
    return rows.select(
        F.col("wanted").alias(limit),
        (F.col("corpus_tokens") - kept[1] + F.col("wanted") * kept[0]).alias("truncated_tokens"),
        kept[0].alias("docs_at_least"),
    )


def length_quantiles(sums: DataFrame, quantiles: list[float]) -> DataFrame:
    """For each q the smallest length that at least a share q of the documents does not exceed."""
    picks = [
        F.struct(F.lit(float(q)).alias("q"), F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias("n_tokens"))
        for q in quantiles
    ]
    return sums.agg(F.array(*picks).alias("picks")).selectExpr("inline(picks)")
