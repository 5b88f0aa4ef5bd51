"""Phrase collocations by FM-indexes over word ids, one per shard of a language. An index holds the
suffix order of the shard's word ids and of their reverse; the interval of a phrase in one is
extended by a word in front, in the other by a word behind, and the two stay in step. Phrases up to
a depth are enumerated with their counts by extending intervals, and counts are added up over
shards. Words too rare for any candidate stand in the index as ends of pieces."""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters that end a piece; blanks and tabs alone lie between words.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_SIGNS = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")


@dataclass(frozen=True)
class Phrases:
    """Words of the longest phrase, occurrences of a candidate, percent of its occurrences inside
    a longer candidate that drop it, phrases kept per language, bytes of text in a shard."""

    longest: int = 3
    least: int = 10
    within: int = 50
    top: int = 2000
    shard_bytes: int = 14_000_000


def shards(docs: DataFrame, how: Phrases) -> DataFrame:
    """shard, lang and data: texts of one language, A-Z lower-cased, packed as they are read.

    A shard is closed at ``shard_bytes``; a longer text is a shard with what came before it. With
    many languages, all are closed once they hold four times that together."""
    source = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        common.text_bytes("text").alias("text"))

    def run(batches):
        first, number = TaskContext.get().partitionId() << 32, 0
        held: dict[str, list[bytes]] = {}
        sizes: Counter = Counter()

        def packed(lang):
            nonlocal number
            sizes.pop(lang)
            row = [first + number, lang, zlib.compress(b"\n".join(held.pop(lang)), 1)]
            number += 1
            types = [pa.int64(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)], ["shard", "lang", "data"])

        for batch in batches:
            for part in common.slices(batch):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held.setdefault(lang, []).append(text.lower())
                    sizes[lang] += len(text) + 1
                    if sizes[lang] >= how.shard_bytes:
                        yield packed(lang)
                if sizes.total() >= 4 * how.shard_bytes:
                    for lang in list(held):
                        yield packed(lang)
        for lang in list(held):
            yield packed(lang)

    return source.mapInArrow(run, "shard long, lang string, data binary")


def _tokens(data: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words, with a line end between pieces and empty strings where blanks meet; whole pieces of
    about ``step`` bytes of text at a time."""
    raw, at = zlib.decompress(data).translate(_SIGNS), 0
    while at < len(raw):
        end = raw.find(b"\n", at + step)
        end = len(raw) if end < 0 else end + 1
        yield raw[at:end].replace(b"\n", b" \n ").split(b" ")
        at = end


def words_of(held: DataFrame) -> DataFrame:
    """shard, lang, word and n of the distinct words of each shard."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts: Counter = Counter()
                for tokens in _tokens(row["data"]):
                    counts.update(tokens)
                counts.pop(b"", None)
                counts.pop(b"\n", None)
                size = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, row["shard"], np.int64)),
                     pa.array([row["lang"]] * size, pa.string()),
                     pa.array(list(counts), pa.binary()),
                     pa.array(list(counts.values()), pa.int64())],
                    ["shard", "lang", "word", "n"])

    return held.mapInArrow(run, "shard long, lang string, word binary, n long")


class Side:
    """Suffix order of word ids by their first few words, the words before the suffixes, and the
    step from a suffix to the one that is longer by that word."""

    def __init__(self, ids: np.ndarray, depth: int):
        n, kinds = ids.size, int(ids.max()) + 1
        padded = np.concatenate([ids, np.zeros(depth, ids.dtype)]).astype(np.int64)
        if depth * kinds.bit_length() < 63:
            key = np.zeros(n, np.int64)
            for j in range(depth):
                key = key * kinds + padded[j : j + n]
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort([padded[j : j + n] for j in range(depth - 1, -1, -1)])
        self.before = ids[order - 1]  # the first suffix has the last id before it: an end
        self.step = np.empty(n, np.int32)
        self.step[np.argsort(self.before, kind="stable")] = np.arange(n, dtype=np.int32)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=kinds))])


class Index:
    """Both sides of a shard; id 0 is the end of a piece and must be first and last."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.sides = Side(ids, depth), Side(ids[::-1].copy(), depth)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, starts of their intervals on both sides, counts."""
        starts = self.sides[0].starts
        count = np.diff(starts)
        ids = np.flatnonzero(count)
        ids = ids[ids > 0]
        return ids, starts[ids], starts[ids], count[ids]

    def extended(self, front: bool, low: np.ndarray, other: np.ndarray, count: np.ndarray):
        """Every extension of the intervals by one word, in front or behind.

        Returns the number of the interval, the word, the start of the new interval on the side
        that was searched and on the other one, and its count. On the other side the extensions
        lie in the order of their words inside the old interval.
        """
        side = self.sides[0 if front else 1]
        owner = np.repeat(np.arange(low.size), count)
        row = np.arange(owner.size) - np.repeat(np.cumsum(count) - count, count) + np.repeat(
            low, count)
        word = side.before[row].astype(np.int64)
        kinds = np.int64(side.starts.size)
        keys, first, found = np.unique(
            owner * kinds + word, return_index=True, return_counts=True)
        parent, word = keys // kinds, keys % kinds
        # What lies before an extension inside its old interval: those by lesser words.
        upto = np.cumsum(found) - found
        opened = np.searchsorted(parent, np.arange(low.size))
        ahead = upto - upto[np.minimum(opened, max(found.size - 1, 0))][parent]
        real = word > 0
        return (parent[real], word[real], side.step[row[first]][real].astype(np.int64),
                (other[parent] + ahead)[real], found[real])


def phrases_of(ids: np.ndarray, longest: int):
    """(ids of the phrases as rows, counts) for each length from 2 on, by turns of a word behind and a
    word in front."""
    if ids.size < 2 or not ids.any():
        return
    index = Index(ids, longest)
    word, low, reverse, count = index.words()
    rows = word[:, None]
    for length in range(2, longest + 1):
        if length % 2 == 0:
            parent, word, reverse, low, count = index.extended(False, reverse, low, count)
            rows = np.concatenate([rows[parent], word[:, None]], 1)
        else:
            parent, word, low, reverse, count = index.extended(True, low, reverse, count)
            rows = np.concatenate([word[:, None], rows[parent]], 1)
        yield rows, count


def _in_order(phrases, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all phrases, 0 behind a shorter one, and counts, in the order of the ids."""
    found = [(np.pad(rows.astype(np.int32), ((0, 0), (0, longest - rows.shape[1]))), count)
             for rows, count in phrases]
    if not found:
        return np.empty((0, longest), np.int32), np.empty(0, np.int64)
    rows, count = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort(rows.T[::-1])
    return rows[order], count[order]


def counted_phrases(held: DataFrame, dictionary: DataFrame, how: Phrases) -> DataFrame:
    """w1, w2, ... (ids, -1 behind a shorter phrase) and the count of each phrase in each shard.

    ``dictionary`` holds shard, word and id of the words to look at; other words end a piece. A shard
    gives its phrases in the order of their ids, which makes them small on their way to the sums.
    """
    names = [f"w{i + 1}" for i in range(how.longest)]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("id")
        numbers = right.column("id").to_numpy()
        local = dict(zip(right.column("word").to_pylist(), range(1, numbers.size + 1)))
        local[b""] = -1
        parts = []
        for row in left.to_pylist():
            found = [np.fromiter(map(local.get, tokens, repeat(0)), np.int32, len(tokens))
                     for tokens in _tokens(row.pop("data"))]
            ids = np.concatenate([[0], *found, [0]]).astype(np.int32)
            ids = ids[ids >= 0]
            # One end between pieces is enough.
            ids = ids[np.concatenate([[True], (ids[1:] > 0) | (ids[:-1] > 0)])]
            if ids[-1]:
                ids = np.append(ids, np.int32(0))
            parts.append(_in_order(phrases_of(ids, how.longest), how.longest))
        local.clear()
        columns = [[numbers[rows[:, j] - 1] for rows, _ in parts] for j in range(how.longest)]
        for j, column in enumerate(columns):
            for i, (rows, _) in enumerate(parts):
                column[i][rows[:, j] == 0] = -1
        columns.append([count for _, count in parts])
        empty = [np.empty(0, np.int64)]
        return pa.table([pa.array(np.concatenate(empty + c).astype(np.int64)) for c in columns],
                        names=[*names, "f"])

    schema = ", ".join(f"{c} long" for c in [*names, "f"])
    return held.groupBy("shard").cogroup(dictionary.groupBy("shard")).applyInArrow(run, schema)


def collocations(docs: DataFrame, stage, how: Phrases = Phrases()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's first ``top`` phrases.

    A candidate is a phrase of 2 to ``longest`` words of one piece with a >= ``least`` occurrences,
    overlapping ones included. Its score is floor(1000000 a a / (l r)) for the cut where that is least
    (ties: the first cut), l and r being the occurrences of what stands before and behind the cut.
    A candidate goes if ``within`` percent of its occurrences or more lie in one longer candidate.
    Order: score, a (both falling), phrase in UTF-8 order. A null text counts as empty, a null
    language as ``und``; repeated rows each count; an empty table gives no rows; other columns are not read.
    """
    names = [f"w{i + 1}" for i in range(how.longest)]
    held = stage(shards(docs, how), "shards")
    words = stage(words_of(held), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(
        F.col("f") >= how.least)
    # Written, so that an id is given once; small ids for frequent words, which then take less room.
    known = stage(
        known.orderBy(F.desc("f")).withColumn("id", F.monotonically_increasing_id()), "known")
    dictionary = words.join(known, ["lang", "word"]).select("shard", "word", "id")
    # A shard names a phrase once, which is all the summing up there is before the shuffle: a table of
    # a task's phrases would take much room and hardly make them fewer. Phrases that begin with the
    # same two words go together, so most of a row stands in the row before it and is packed away.
    counts = counted_phrases(held, dictionary, how).repartition(*names[:2]).groupBy(*names).agg(
        F.sum("f").alias("f"))
    found = stage(counts.filter(F.col("f") >= how.least), "candidates")

    kept = _scored(found, known, names)
    if how.longest > 2:
        drops = F.coalesce(100 * F.col("inside") >= how.within * F.col("a"), F.lit(False))
        kept = kept.join(_most_inside(found, names), names, "left").filter(~drops)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # Spark cuts each task's part to the first rows of a language before they meet.
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= how.top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _part(row: list[str], size: int) -> list[Column]:
    return [F.col(c) for c in row] + [F.lit(-1).cast("long")] * (size - len(row))


def _of_size(found: DataFrame, names: list[str], size: int) -> DataFrame:
    ends = F.col(names[size - 1]) >= 0
    return found.filter(ends & (F.col(names[size]) < 0) if size < len(names) else ends)


def _scored(found: DataFrame, known: DataFrame, names: list[str]) -> DataFrame:
    """Candidates with lang, phrase, a, and l, r and score of the cut that counts."""
    texts = known.select("id", "lang", F.col("word").cast("string").alias("word"), "f")
    result = None
    for size in range(2, len(names) + 1):
        rows = _of_size(found, names, size).withColumnRenamed("f", "a")
        for i in range(size):
            one = texts.select(F.col("id").alias(names[i]), F.col("word").alias(f"t{i}"),
                               F.col("f").alias(f"f_{i}_{i + 1}"), *["lang"][i:])
            rows = rows.join(one, names[i])
        # A part of a candidate occurs as often at least, so it is counted.
        for k in range(2, size):
            parts = _of_size(found, names, k)
            for i in {0, size - k}:
                here = parts.select(*[F.col(names[j]).alias(names[i + j]) for j in range(k)],
                                    F.col("f").alias(f"f_{i}_{i + k}"))
                rows = rows.join(here, names[i : i + k])
        cuts = [
            F.struct(
                F.expr(
                    "cast((1000000BD * cast(a as decimal(13,0)) * cast(a as decimal(13,0))) div"
                    f" (cast(f_0_{k} as decimal(19,0)) * cast(f_{k}_{size} as decimal(19,0)))"
                    " as bigint)").alias("score"),
                F.lit(k).alias("k"), F.col(f"f_0_{k}").alias("l"),
                F.col(f"f_{k}_{size}").alias("r"))
            for k in range(1, size)
        ]
        part = rows.withColumn("cut", F.array_min(F.array(*cuts))).select(
            *names, "lang", F.concat_ws(" ", *[f"t{i}" for i in range(size)]).alias("phrase"),
            "a", "cut.l", "cut.r", "cut.score")
        result = part if result is None else result.unionByName(part)
    return result


def _most_inside(found: DataFrame, names: list[str]) -> DataFrame:
    """Phrases that lie in a longer candidate, with the most occurrences of one such."""
    longest = len(names)
    parts = []
    for size in range(2, longest):
        for i in range(0, longest - size + 1):
            # Longer by at least one word: something must stand before or behind the part.
            outside = F.lit(True) if i else F.col(names[size]) >= 0
            parts.append(F.when(
                (F.col(names[i + size - 1]) >= 0) & outside,
                F.struct(*[c.alias(n) for n, c in zip(names, _part(names[i : i + size], longest))])))
    inside = found.select("f", F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull()))
                          .alias("p"))
    return inside.groupBy(*[F.col(f"p.{n}").alias(n) for n in names]).agg(
        F.max("f").alias("inside"))
