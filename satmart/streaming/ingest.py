"""Incremental ingest: attendance arrives file by file; partial sums per grain are merged, or the
published star is kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from satmart.operators.ingest import (
    OBSERVATION_SCHEMA,
    cleaned,
    merge_observations,
    observations,
)
from satmart.plans import jobs
from satmart.settings import Settings
from satmart.sources.storage import child_names, exists, remove
from satmart.sources.warehouse import Warehouse


def ingest_new_files(
    raw_stream: DataFrame, activity: str, partials: str, checkpoint: str
) -> StreamingQuery:
    """Aggregate the files that arrived since the last run and add their sums to ``partials``.

    Each micro-batch overwrites its own folder, so a batch repeated after a failure counts
    once. No state grows with the history: merging is a batch job over the partial sums.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        observations(batch, activity).write.mode("overwrite").parquet(f"{partials}/batch={batch_id}")

    return (
        cleaned(raw_stream, activity)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _numbered(spark: SparkSession, partials: str, kind: str) -> list[int]:
    """Numbers of the finished folders of a kind, ascending."""
    names = [n for n in child_names(spark, partials) if n.startswith(f"{kind}=")]
    done = [n for n in names if exists(spark, f"{partials}/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix(f"{kind}=")) for n in done)


def _unmerged(spark: SparkSession, partials: str) -> tuple[list[str], int | None]:
    """The last total and the batches that came after it, and the number of the last of all.

    A total is named after the last batch in it, so one cut off half-way changes nothing."""
    totals, batches = (_numbered(spark, partials, kind) for kind in ("total", "batch"))
    last = totals[-1] if totals else -1
    newer = [b for b in batches if b > last]
    paths = [f"{partials}/total={last}"] * bool(totals) + [f"{partials}/batch={b}" for b in newer]
    return paths, newer[-1] if newer else None


def merged_observations(spark: SparkSession, partials: str) -> DataFrame:
    """Observations of everything ingested so far; none before the first batch."""
    paths, _ = _unmerged(spark, partials)
    if not paths:
        return spark.createDataFrame([], OBSERVATION_SCHEMA)
    return merge_observations(spark.read.schema(OBSERVATION_SCHEMA).parquet(*paths))


def compact(spark: SparkSession, partials: str) -> None:
    """Merge the batches since the last total into a new one.

    A later merge then reads one total and the batches after it, however many there were. The total's
    name says up to which batch it goes, so what it holds is not read again; the merged folders stay
    for readers that are under way, until ``remove_merged``.
    """
    _, last = _unmerged(spark, partials)
    if last is not None:
        merged_observations(spark, partials).write.mode("overwrite").parquet(
            f"{partials}/total={last}")


def remove_merged(spark: SparkSession, partials: str) -> None:
    """Free the space of what the last total holds, when no reader is under way."""
    totals = _numbered(spark, partials, "total")
    for kind, numbers in (("total", totals[:-1]), ("batch", _numbered(spark, partials, "batch"))):
        for number in numbers:
            if totals and number <= totals[-1]:
                remove(spark, f"{partials}/{kind}={number}")


def keep_star(
    raw_stream: DataFrame, known: DataFrame | None, warehouse: Warehouse, s: Settings,
    checkpoint: str, name: str = "stream",
) -> StreamingQuery:
    """Adds the files that arrived since the last run to the published star, batch by batch.

    The first batch of an empty warehouse loads it; a later one derives anew what its rows touch:
    their months, facilities and geographies. The warehouse keeps the names of the batches it holds
    in the release that holds their rows, so a batch repeated after a failure counts once.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        add = jobs.add_attendance if warehouse.tables() else jobs.load_star
        add(batch, known, warehouse, s, batch=f"{name}-{batch_id}")

    return (
        raw_stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
