"""Token counts: an exact histogram of encoded lengths, with suffix sums.

Every text is encoded whole; per length the histogram holds the documents and
their tokens, and suffix sums answer for each context limit how many documents
and tokens lie at or above it and how many tokens stay when every document is
cut at the limit.  Suffix sums run in two levels (blocks of lengths, then
lengths within a block), so no task sees the whole histogram.

Cases: a null or empty text has length 0; equal texts and rows count each; an
empty table gives an empty histogram; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import column, map_arrow, slices, staged
from ticklake.llm.encoding import encoder


def encoded_lengths(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(n_tokens, n_docs): lengths of whole texts, already summed within each task's batches."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for part in slices(batches):
            length, n = np.unique(enc.counts(column(part, "text")), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array(n, pa.int64())],
                                             names=["n_tokens", "n_docs"])

    return map_arrow(docs.select(F.col("text").cast("string")), step, "n_tokens long, n_docs long")


def length_histogram(docs: DataFrame, vocabulary: str, block: int = 256) -> DataFrame:
    """One row per length L that occurs.

    n_docs, token_sum: documents of length L and their tokens; docs_ge,
    tokens_ge: the same from L on; total_docs, total_tokens: of the corpus;
    truncated_tokens: tokens left when every document is cut at L.
    """
    # written, as it is read twice: texts are encoded once
    counts = staged(encoded_lengths(docs, vocabulary).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "lengths")
    hist = (counts.withColumn("token_sum", F.col("n_tokens") * F.col("n_docs"))
            .withColumn("_block", F.floor(F.col("n_tokens") / block)))
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("_block"))
    blocks = (hist.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("token_sum").alias("_t"))
              .select(F.col("_block").alias("_b"),
                      (F.sum("_d").over(above) - F.col("_d")).alias("_docs_above"),
                      (F.sum("_t").over(above) - F.col("_t")).alias("_tokens_above"),
                      F.sum("_d").over(Window.partitionBy(F.lit(0))).alias("total_docs"),
                      F.sum("_t").over(Window.partitionBy(F.lit(0))).alias("total_tokens")))
    inside = Window.partitionBy("_block").orderBy(F.desc("n_tokens"))
    out = (hist.withColumn("_d", F.sum("n_docs").over(inside)).withColumn("_t", F.sum("token_sum").over(inside))
           .join(blocks, F.col("_block") == F.col("_b"))
           .withColumn("docs_ge", F.col("_d") + F.col("_docs_above"))
           .withColumn("tokens_ge", F.col("_t") + F.col("_tokens_above")))
    return out.select(
        "n_tokens", "n_docs", "token_sum", "docs_ge", "tokens_ge", "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")).alias("truncated_tokens"))


def quantiles(histogram: DataFrame, probabilities: list[float]) -> DataFrame:
    """(probability, n_tokens): the smallest length with at least that share of the documents at or below it."""
    below = F.col("total_docs") - F.col("docs_ge") + F.col("n_docs")
    asked = F.explode(F.array(*(F.lit(float(p)) for p in probabilities))).alias("probability")
    return (histogram.select("n_tokens", below.alias("_below"), "total_docs", asked)
            .filter(F.col("_below") >= F.ceil(F.col("probability") * F.col("total_docs")))
            .groupBy("probability").agg(F.min("n_tokens").alias("n_tokens")))
