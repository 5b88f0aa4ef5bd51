"""Exact repeated passages by prefix doubling over sampled suffixes, in any number of tasks.

A string of ``threshold`` bytes is judged by the place in its head window whose hash is least, so
equal strings choose equal places. The first ranks are names of the ``start`` bytes at the chosen
places; a place whose name is its own is done, nothing around it repeats. Starts that chose the same
place are a run: a run that occurs again as a whole repeats in all its starts. What is left is cut
into short runs and judged again, and every start of those still open is ranked: the ranks of a
start and of the one ``length`` bytes on make a pair, pairs are sorted, those that occur once leave,
the others get their place in the order as the new rank, and the length doubles until it reaches the
threshold."""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satmart.llm import common
from satmart.llm.qgram_lemma import gram_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCK = "block long, doc_ids array<long>, lengths array<long>, data binary"
_PLACE = np.uint64((1 << 28) - 1)


@dataclass(frozen=True)
class Repeats:
    """Bytes of a repeat; bytes of the first ranks; bytes hashed to choose a place; starts of a short
    run; bytes of text in a block and looked at in one go."""

    threshold: int = 200
    start: int = 100
    gram: int = 16
    short: int = 8
    block_bytes: int = 4_000_000
    part_bytes: int = 1 << 20

    @property
    def window(self) -> int:
        """Places to choose from: from any of them ``start`` bytes still lie in the string."""
        return self.threshold - self.start + 1

    @property
    def reach(self) -> int:
        """Bytes from a start to the end of all that is looked at with it."""
        return self.threshold + self.window + self.gram


def blocks(docs: DataFrame, how: Repeats) -> DataFrame:
    """Texts packed in the order in which they are read; a longer text closes its block."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         common.text_bytes("text").alias("text"))
    names = [part.split()[0] for part in _BLOCK.split(", ")]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def run(batches):
        first, number = TaskContext.get().partitionId() << 32, 0
        ids, texts, size = [], [], 0

        def packed():
            nonlocal ids, texts, size, number
            data = zstandard.ZstdCompressor(level=6).compress(b"".join(texts))
            row = [first + number, ids, [len(t) for t in texts], data]
            ids, texts, size, number = [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in batches:
            for part in common.slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(doc_id)
                    texts.append(text)
                    size += len(text)
                    if size >= how.block_bytes:
                        yield packed()
        if ids:
            yield packed()

    return source.mapInArrow(run, _BLOCK)


def _bytes(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a block in a row, and where each ends."""
    ends = np.cumsum(np.array(row["lengths"], np.int64))
    data = zstandard.ZstdDecompressor().decompress(row["data"]) if ends[-1] else b""
    return np.frombuffer(data, np.uint8), ends


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[: keys.size - rest], keys[rest:]) if rest else keys


def _name(names: np.ndarray, low: np.ndarray, stop: np.ndarray, how: Repeats) -> np.ndarray:
    """A hash of the bytes from low to stop, put together from the names of ``start`` bytes each."""
    odds, out = common.odd_numbers(32, 11), names[low]
    for j in range(1, -(-how.reach // how.start)):
        out = common.mix(out) * odds[j % 32] + names[np.minimum(low + j * how.start, stop - how.start)]
    return out


def _run_names(names, low, high, own, first, last, how: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """(core, hull) of runs of starts low to high that chose the place ``own``. The core is what all
    strings hold that start between first and last and chose that place, wherever a run is cut off
    by the ends of a text or by better places; the hull is all bytes of the run's own strings."""
    sides = [(own - x).astype(np.uint64) for x in (first, last, low, high)]
    odds = common.odd_numbers(4, 12)
    core = _name(names, last, first + how.threshold, how) + odds[0] * sides[0] + odds[1] * sides[1]
    hull = _name(names, low, high + how.threshold, how) + odds[2] * sides[2] + odds[3] * sides[3]
    return common.mix(core).view(np.int64), common.mix(hull).view(np.int64)


def sampled(data: np.ndarray, ends: np.ndarray, how: Repeats) -> list[np.ndarray]:
    """core, hull, low, high, own: runs of starts that chose the same place."""
    found = []
    for at in range(0, data.size, how.part_bytes):
        part = data[at : at + how.part_bytes + how.reach].astype(np.uint64)
        if part.size < how.threshold:
            break
        grams = gram_hashes(part, how.gram)
        keys = (grams & ~_PLACE) | np.arange(grams.size, dtype=np.uint64)
        chosen = (_least(keys, how.window) & _PLACE).astype(np.int64)
        place = np.arange(at, min(at + how.part_bytes, at + chosen.size))
        end = ends[np.searchsorted(ends, place, "right")]
        start = np.flatnonzero(end - place >= how.threshold)
        if not start.size:
            continue
        own = chosen[start]
        first = np.flatnonzero(np.concatenate(
            [[True], (np.diff(start) > 1) | (np.diff(own) != 0)]))
        last = np.append(first[1:], start.size) - 1
        low, high, own = start[first], start[last], own[first]
        names = gram_hashes(part, how.start)
        core, hull = _run_names(names, low, high, own, own - how.window + 1, own, how)
        found.append((core, hull, low + at, high + at, own + at))
    if not found:
        return [np.empty(0, np.int64)] * 5
    return [np.concatenate(c) for c in zip(*found)]


def _joined(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges that touch or overlap as one, and the number of the first of each."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    first = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1] + 1])) if low.size else (
        np.empty(0, np.int64))
    return low[first], np.append(high[first[1:] - 1], high[-1:]), order[first]


_RUNS = "block long, core long, hull long, n long, low int, high int, own int, known boolean"


def _rows(block: int, core, hull, low, high, own) -> list[np.ndarray]:
    """Columns of ``_RUNS``: equal runs of a block once with their number n. All starts of equal runs
    repeat: they follow as ``known`` ranges with n = 0, under the core of one of them."""
    order = np.lexsort([low, hull, core])
    same = (np.diff(core[order]) == 0) & (np.diff(hull[order]) == 0)
    first = np.flatnonzero(np.concatenate([[True], ~same])) if order.size else order
    n = np.diff(np.append(first, order.size))
    again = order[np.repeat(n > 1, n)]
    known_low, known_high, at = _joined(low[again], high[again])
    one, more = order[first], again[at]
    both = np.concatenate([one, more])
    return [
        np.full(both.size, block, np.int64), core[both], hull[both],
        np.concatenate([n, np.zeros(more.size, np.int64)]),
        np.concatenate([low[one], known_low]).astype(np.int32),
        np.concatenate([high[one], known_high]).astype(np.int32),
        own[both].astype(np.int32), np.arange(both.size) >= one.size,
    ]


def _names_of(kind: str) -> list[str]:
    return [part.split()[0] for part in kind.split(", ")]


def long_runs(held: DataFrame, how: Repeats) -> DataFrame:
    """Runs of starts that chose the same place, of each block."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                columns = _rows(row["block"], *sampled(*_bytes(row), how))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _names_of(_RUNS))

    return held.mapInArrow(run, _RUNS)


def short_runs(held: DataFrame, open_: DataFrame, how: Repeats) -> DataFrame:
    """The open runs (block, low, high, own) cut into runs of ``short`` starts, counted from the place
    that they chose, so that equal strings lie in equal runs."""
    def cut(row: dict, low, high, own):
        data, _ = _bytes(row)
        far = (own - low) // how.short
        pieces = far - (own - high) // how.short + 1
        owner = np.repeat(np.arange(low.size), pieces)
        j = np.repeat(far + 1, pieces) - 1 - (
            np.arange(owner.size) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        own = own[owner]
        first, last = own - (j + 1) * how.short + 1, own - j * how.short
        low, high = np.maximum(low[owner], first), np.minimum(high[owner], last)
        order = np.argsort(low, kind="stable")
        low, high, own, first, last = (c[order] for c in (low, high, own, first, last))
        core, hull = np.empty(low.size, np.int64), np.empty(low.size, np.int64)
        for a in range(0, data.size, how.part_bytes):
            i, k = np.searchsorted(low, [a, a + how.part_bytes])
            if i < k:
                b = max(0, a - how.short)
                part = data[b : a + how.part_bytes + how.reach].astype(np.uint64)
                here = (c[i:k] - b for c in (low, high, own, first, last))
                core[i:k], hull[i:k] = _run_names(gram_hashes(part, how.start), *here, how)
        return core, hull, low, high, own

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        runs = [right.column(c).to_numpy().astype(np.int64) for c in ("low", "high", "own")]
        rows = left.to_pylist() if runs[0].size else []
        found = [_rows(row["block"], *cut(row, *runs)) for row in rows]
        empty = _arrow(_RUNS).empty_table()
        return pa.concat_tables([empty, *[
            pa.table([pa.array(c) for c in columns], schema=empty.schema) for columns in found]])

    return held.groupBy("block").cogroup(open_.groupBy("block")).applyInArrow(run, _RUNS)


def _arrow(kind: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(n, types[t]) for n, t in (part.split() for part in kind.split(", "))])


def judged(runs: DataFrame, stage, name: str) -> tuple[DataFrame, DataFrame]:
    """(ranges of starts that repeat, runs that may repeat in part: one of each equal).

    A core that occurs once settles that nothing repeats; a hull that occurs twice, that all does.
    Cores and hulls are counted before they are joined, and the join may split a frequent one."""
    cores = runs.groupBy("core").agg(
        F.sum("n").alias("n"), F.min("hull").alias("least"), F.max("hull").alias("most"))
    repeated = cores.filter("n > 1").select("core", (F.col("least") != F.col("most")).alias("mixed"))
    is_open = F.col("mixed") & ~F.col("known")
    met = stage(
        runs.join(repeated, "core").select(
            "block", "low", "high", is_open.alias("open"),
            *[F.when(is_open, F.col(c)).alias(c) for c in ("core", "hull", "own")]),
        f"{name}_runs")
    hulls = stage(
        met.filter("open").groupBy("core", "hull").agg(
            F.count("*").alias("n"), F.min(F.struct("block", "low", "high", "own")).alias("one")),
        f"{name}_hulls")
    again = met.filter("open").join(hulls.filter("n > 1"), ["core", "hull"], "left_semi")
    ranges = [df.select("block", "low", "high") for df in (met.filter("NOT open"), again)]
    return ranges[0].unionByName(ranges[1]), hulls.select("one.*")


def _bucketed(df: DataFrame, stage) -> DataFrame:
    """Written once by hash of the block, so that what is found out about a block later meets its
    text without a shuffle of texts."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"blocks_{uuid.uuid4().hex}"
    df.repartition(n, "block").write.bucketBy(n, "block").option(
        "path", f"{stage.root}/{name}").saveAsTable(name)
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return held


def first_pairs(held: DataFrame, open_: DataFrame, how: Repeats) -> DataFrame:
    """block, at, ahead, behind: names of the ``start`` bytes at every start of the ranges ``open_``
    (block, low, high), and of those after them; also for starts further on that later rounds ask for.
    """
    kind = "block long, at int, ahead long, behind long"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [[np.empty(0, np.int64)] for _ in range(4)]
        low, high = (right.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
        for row in left.to_pylist() if low.size else []:
            data, _ = _bytes(row)
            wanted = np.zeros(data.size + 1, np.int32)
            step = min(2 * how.start, how.threshold)
            for j in range(0, max(1, how.threshold - step + 1), how.start):
                np.add.at(wanted, low + j, 1)
                np.add.at(wanted, high + j + 1, -1)
            # The last of the pairs ends where the string does.
            np.add.at(wanted, low + how.threshold - step, 1)
            np.add.at(wanted, high + how.threshold - step + 1, -1)
            at = np.flatnonzero(np.cumsum(wanted)[:-1] > 0)
            for a in range(0, data.size, how.part_bytes):
                here = at[np.searchsorted(at, a) : np.searchsorted(at, a + how.part_bytes)]
                if here.size:
                    part = data[a : a + how.part_bytes + 2 * how.start].astype(np.uint64)
                    names = gram_hashes(part, how.start).view(np.int64)
                    found[0].append(np.full(here.size, row["block"], np.int64))
                    found[1].append(here)
                    found[2].append(names[here - a])
                    found[3].append(names[here - a + step - how.start])
        columns = [np.concatenate(c) for c in found]
        columns[1] = columns[1].astype(np.int32)
        return pa.table([pa.array(c) for c in columns], names=["block", "at", "ahead", "behind"])

    return held.groupBy("block").cogroup(open_.groupBy("block")).applyInArrow(run, kind)


def doubled(pairs: DataFrame, stage, how: Repeats) -> DataFrame:
    """block and at of the starts whose ``threshold`` bytes occur again, from the first pairs."""
    length = min(2 * how.start, how.threshold)
    while True:
        pairs = stage(pairs, f"pairs_{length}")
        # Counted before they are sorted: a pair that occurs everywhere is one row of a task.
        again = pairs.groupBy("ahead", "behind").agg(F.count("*").alias("n")).filter("n > 1")
        ranks = stage(
            again.orderBy("ahead", "behind").select(
                "ahead", "behind", F.monotonically_increasing_id().alias("rank")),
            f"ranks_{length}")
        ranked = pairs.join(ranks, ["ahead", "behind"]).select("block", "at", "rank")
        if length >= how.threshold:
            return ranked.select("block", "at")
        ranked = stage(ranked, f"ranked_{length}")
        offset = min(length, how.threshold - length)
        on = ranked.select("block", (F.col("at") - offset).alias("at"),
                           F.col("rank").alias("behind"))
        pairs = ranked.withColumnRenamed("rank", "ahead").join(on, ["block", "at"])
        length += offset


def _cut(held: DataFrame, ranges: DataFrame, how: Repeats) -> DataFrame:
    schema = ("doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, "
              "kept binary")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        low, high = (right.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
        columns = [[], [], [], []]
        for row in left.to_pylist():
            data, ends = _bytes(row)
            low_, high_, _ = _joined(low, high + how.threshold - 1)
            begins = ends - np.array(row["lengths"], np.int64)
            # A string lies in one text, but ranges of neighbouring texts may touch.
            cuts = np.unique(np.concatenate([low_, begins]))
            inside = np.searchsorted(low_, cuts, "right") - 1
            real = inside >= 0
            real[real] = high_[inside[real]] >= cuts[real]
            starts = cuts[real]
            text = np.searchsorted(ends, starts, "right")
            stops = np.minimum(high_[inside[real]] + 1, ends[text]) if starts.size else starts
            first = np.searchsorted(text, np.arange(ends.size + 1))
            raw = data.tobytes()
            for i, (a, b) in enumerate(zip(begins.tolist(), ends.tolist())):
                own = slice(first[i], first[i + 1])
                pieces, at = [], a
                for x, y in zip(starts[own].tolist(), stops[own].tolist()):
                    pieces.append(raw[at:x])
                    at = y
                columns[0].append(row["doc_ids"][i])
                columns[1].append(b - a)
                columns[2].append([{"start": x - a, "stop": y - a} for x, y in zip(
                    starts[own].tolist(), stops[own].tolist())])
                columns[3].append(b"".join([*pieces, raw[at:b]]))
        types = [pa.int64(), pa.int64(), span, pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)],
                        names=["doc_id", "n_bytes", "spans", "kept"])

    return held.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(run, schema)


def without_repeats(docs: DataFrame, stage, how: Repeats = Repeats()) -> DataFrame:
    """doc_id, n_bytes, spans and kept of every row of ``docs`` (doc_id, text).

    ``spans`` are the maximal runs of bytes of the text's UTF-8 form that lie in a string of
    ``threshold`` bytes which also starts anywhere else, in the same text or another, overlapping or
    not; ``kept`` are the other bytes. A null text counts as empty, shorter texts keep all; repeated
    rows repeat each other's bytes; ties do not matter, since every copy goes; a null or repeated
    doc_id is carried only; an empty table gives an empty result; texts of any length are looked at
    whole, a part at a time; other columns are not read.

    Strings are compared by two 64-bit hashes of their parts. Blocks of texts are written once; what
    is known of a block meets it again by its number, so no text is sorted or grouped.
    """
    held = _bucketed(blocks(docs, how), stage)
    sure, open_ = judged(long_runs(held, how), stage, "long")
    more, open_ = judged(short_runs(held, open_, how), stage, "short")
    found = doubled(first_pairs(held, open_, how), stage, how).select(
        "block", F.col("at").alias("low"), F.col("at").alias("high"))
    return _cut(held, sure.unionByName(more).unionByName(found), how)
