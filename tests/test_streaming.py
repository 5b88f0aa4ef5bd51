"""Incremental ingest gives the same observations as one batch over all files."""

import os

from conftest import SF_SMALL

from satmart.operators.ingest import cleaned, observations
from satmart.plans import roles
from satmart.plans.catalogue import QUERIES
from satmart.sources.delimited import stream_delimited, write_delimited
from satmart.streaming.ingest import (
    compact, ingest_new_files, merged_observations, remove_merged,
)


def test_stream_of_files_equals_batch(spark, workdir):
    raw = roles.raw_attendance(spark, SF_SMALL)
    early, late = raw.where("PERIODO < '199801'"), raw.where("PERIODO >= '199801'")
    landing = os.path.join(workdir, "landing")
    partials, checkpoint = f"{workdir}/partials", f"{workdir}/checkpoint"

    def arrive():
        stream = spark.readStream.schema(raw.schema).parquet(landing)
        ingest_new_files(stream, "Consultas", partials, checkpoint).awaitTermination()

    assert merged_observations(spark, partials).isEmpty()
    compact(spark, partials)
    early.write.parquet(landing)
    arrive()
    arrive()  # nothing new: nothing is counted twice
    compact(spark, partials)
    reader = merged_observations(spark, partials)
    n = reader.count()
    remove_merged(spark, partials)
    assert os.listdir(partials) == ["total=0"]
    late.write.mode("append").parquet(landing)
    arrive()
    compact(spark, partials)
    compact(spark, partials)
    assert reader.count() == n  # begun before the compaction, which left its files
    remove_merged(spark, partials)
    assert os.listdir(partials) == ["total=1"]
    got = merged_observations(spark, partials)
    want = observations(cleaned(raw), "Consultas").select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_delimited_files_can_be_streamed(spark, workdir):
    raw = roles.raw_attendance(spark, SF_SMALL)
    write_delimited(raw, f"{workdir}/landing")
    stream = stream_delimited(spark, f"{workdir}/landing", raw.columns)
    run = ingest_new_files(stream, "Consultas", f"{workdir}/partials", f"{workdir}/checkpoint")
    run.awaitTermination()
    got = merged_observations(spark, f"{workdir}/partials")
    want = observations(cleaned(raw), "Consultas").select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_stream_query_reads_a_table_of_many_files(spark, workdir):
    for name in roles.TABLES:
        table = roles.table(spark, SF_SMALL, name)
        table.repartition(3 if name == "lineitem" else 1).write.parquet(f"{workdir}/{name}.parquet")
    got = QUERIES["stream_fact_aggregate"](spark, workdir)
    want = QUERIES["fact_aggregate"](spark, SF_SMALL)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
