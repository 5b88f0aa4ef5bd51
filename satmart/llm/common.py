"""Shared by the text operators: reading, carrying columns through Arrow batches, hashing."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

# Executors get the helpers by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of an Arrow batch that are turned into Python objects at a time.
ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of, F.lit(0))


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text; null counts as the empty text."""
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")


def row_of(columns: list[str]) -> Column:
    """The columns to carry, packed so that no new column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")


def slices(batch: pa.RecordBatch, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def over_batches(
    docs: DataFrame,
    carry: list[str],
    text: str,
    measure: Callable[[list[bytes]], list],
    fields: list[StructField],
) -> DataFrame:
    """``row`` (the carried columns) and the fields that ``measure`` returns for some whole texts."""
    source = docs.select(row_of(carry), text_bytes(text).alias("text"))
    schema = StructType([source.schema["row"], *fields])
    types = [to_arrow_type(f.dataType) for f in fields]
    names = schema.names

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = measure(part.column(1).to_pylist())
                arrays = [pa.array(v, t) for v, t in zip(found, types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=names)

    return source.mapInArrow(run, schema)


def over_texts(
    docs: DataFrame,
    carry: list[str],
    text: str,
    measure: Callable[[bytes], tuple],
    fields: list[StructField],
) -> DataFrame:
    """As ``over_batches``, for a function of one text."""
    return over_batches(docs, carry, text, lambda texts: list(zip(*map(measure, texts))), fields)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)
