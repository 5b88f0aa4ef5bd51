"""Packing by optimal length buckets: the global histogram of lengths, cut by dynamic programming
into the buckets that need the least padding; inside a bucket, rows form batches that fill a token
budget."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Shape:
    """Longest piece, number of buckets, tokens of a padded batch, rows numbered by one task."""

    longest: int = 8_192
    buckets: int = 12
    batch_tokens: int = 65_536
    shard_rows: int = 100_000


def word_tokens(text: str = "text") -> Column:
    """Words of a text and one end token; null counts as empty."""
    return (F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)) + 1).cast("long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding.

    Exact. With C the running count, the best cost of the first j lengths in b buckets is the least
    over i < j of cost[b-1][i] + length[j] * (C[j] - C[i]): lines in length[j] whose slopes fall,
    asked for ever larger lengths, so a lower hull answers all of a bucket in one sweep. Of equal
    costs the one with the fewest buckets wins.
    """
    order = np.argsort(lengths)
    size = [int(v) for v in lengths[order]]
    running = [0, *np.cumsum(counts[order]).tolist()]
    n = len(size)
    if not n:
        return []
    cost = [0] + [None] * n
    back: list[list[int]] = []
    best = (None, 0)
    for b in range(1, min(buckets, n) + 1):
        new, came = [None] * (n + 1), [0] * (n + 1)
        hull: deque[tuple[int, int, int]] = deque()  # slope, intercept, i
        for j in range(1, n + 1):
            i = j - 1
            if cost[i] is not None:
                line = (-running[i], cost[i], i)
                while len(hull) > 1:
                    (m1, c1, _), (m2, c2, _) = hull[-2], hull[-1]
                    if (line[1] - c1) * (m1 - m2) <= (c2 - c1) * (m1 - line[0]):
                        hull.pop()
                    else:
                        break
                hull.append(line)
            x = size[j - 1]
            while len(hull) > 1 and hull[0][0] * x + hull[0][1] >= hull[1][0] * x + hull[1][1]:
                hull.popleft()
            if hull:
                new[j] = hull[0][0] * x + hull[0][1] + x * running[j]
                came[j] = hull[0][2]
        back.append(came)
        if best[0] is None or new[n] < best[0]:
            best = (new[n], b)
        cost = new
    ends, j = [], n
    for b in range(best[1], 0, -1):
        ends.append(size[j - 1])
        j = back[b - 1][j]
    return ends[::-1]


def pieces(docs: DataFrame, tokens: Column, shape: Shape) -> DataFrame:
    """doc_id, piece, start and n_tokens: documents over the longest length in several pieces."""
    sized = docs.select("doc_id", tokens.alias("tokens"))
    last = F.floor((F.col("tokens") - 1) / shape.longest).cast("long")
    start = F.col("piece") * shape.longest
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    return sized.select("doc_id", "tokens", numbers).select(
        "doc_id", "piece", start.alias("start"),
        F.least(F.lit(shape.longest), F.col("tokens") - start).cast("long").alias("n_tokens"),
    )


def packed(docs: DataFrame, tokens: Column, stage, shape: Shape = Shape()) -> DataFrame:
    """doc_id, piece, start, n_tokens, bucket, bucket_length, batch, slot and padding per piece.

    ``tokens`` is an expression of at least 1. The histogram has at most ``longest`` rows, and only
    it comes to the driver. Documents longer than ``longest`` are cut into pieces, none is dropped.
    A row's place in its bucket is its number in the order of doc_id and piece, at any size and on
    any splits: rows are dealt to ranges of (bucket, doc_id, piece), numbered in each range and
    shifted by the sizes of the ranges before. No task sorts more than about ``shard_rows`` rows, and
    only the last batch of a bucket can be short. Repeated rows get a place each, the shorter first;
    a null doc_id comes last. An empty table gives no rows; columns other than doc_id and those in
    ``tokens`` are not read, so none can clash.
    """
    numbered = pieces(docs, tokens, shape).withColumn("row_no", F.monotonically_increasing_id())
    rows = stage(numbered, "pieces")
    histogram = sorted(tuple(r) for r in rows.groupBy("n_tokens").count().collect())
    lengths = np.array([r[0] for r in histogram], np.int64)
    counts = np.array([r[1] for r in histogram], np.int64)
    ends = boundaries(lengths, counts, shape.buckets)
    bucket, top, n_ranges = F.lit(0), F.lit(0).cast("long"), 0
    low = [0, *ends]
    for k in reversed(range(len(ends))):
        inside = int(counts[(lengths > low[k]) & (lengths <= ends[k])].sum())
        fits = F.col("n_tokens") <= ends[k]
        bucket = F.when(fits, F.lit(k)).otherwise(bucket)
        top = F.when(fits, F.lit(ends[k]).cast("long")).otherwise(top)
        n_ranges += -(-inside // shape.shard_rows)
    # Rows that tie in all but row_no are alike, so their order does not show.
    order = [F.col("doc_id").asc_nulls_last(), "piece", "n_tokens", "row_no"]
    ranged = rows.withColumns({"bucket": bucket, "bucket_length": top}).repartitionByRange(
        max(1, n_ranges), "bucket", *order).withColumn("shard", F.spark_partition_id())
    # Written, so that sizes and numbers come from the same ranges.
    placed = stage(ranged, "ranges")
    in_shard = W.partitionBy("bucket", "shard").orderBy(*order)
    before = W.partitionBy("bucket").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    bases = sizes.select("bucket", "shard",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    capacity = F.greatest(F.lit(1), F.floor(F.lit(shape.batch_tokens) / F.col("bucket_length")))
    return (
        placed.withColumn("place", F.row_number().over(in_shard) - 1)
        .join(bases, ["bucket", "shard"])
        .withColumn("place", F.col("place") + F.col("base"))
        .select("doc_id", "piece", "start", "n_tokens", "bucket", "bucket_length",
                F.floor(F.col("place") / capacity).alias("batch"),
                (F.col("place") % capacity).alias("slot"),
                (F.col("bucket_length") - F.col("n_tokens")).alias("padding"))
    )
