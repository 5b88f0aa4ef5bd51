"""Prediction by partial matching over bytes. Counts of byte contexts form a trie of order K; the
code length of a byte comes from the longest context that was seen, escapes (method C) lead to
shorter contexts, and symbols that a longer context has are excluded from the shorter one.

Nothing that grows with the corpus is broadcast: texts lie in blocks, each block names the words
and (K+1)-grams it holds, their counts and code lengths are joined to those names, and each block
meets its own dictionary again to score its texts."""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Stands before the first byte and after the last; no UTF-8 text holds it.
EDGE = 255
_BLOCK = "block long, doc_ids array<long>, trains array<boolean>, lengths array<long>, data binary"


@dataclass(frozen=True)
class Shape:
    """Order of the trie, bytes of text in a block, bytes that numpy looks at in one go."""

    order: int = 4
    block_bytes: int = 14_000_000
    part_bytes: int = 1_000_000


def blocks(docs: DataFrame, trains: Column, shape: Shape) -> DataFrame:
    """Texts, A-Z lower-cased, packed together in the order in which they are read."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         common.text_bytes("text").alias("text"), trains.alias("trains"))
    names = [part.split()[0] for part in _BLOCK.split(", ")]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()),
             pa.binary()]

    def run(batches):
        first, number = TaskContext.get().partitionId() << 32, 0
        ids, flags, texts, size = [], [], [], 0

        def packed():
            row = [first + number, ids, flags, [len(t) for t in texts],
                   zlib.compress(b"".join(texts), 1)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in batches:
            for part in common.slices(batch):
                for doc_id, text, flag in zip(*(part.column(i).to_pylist() for i in range(3))):
                    ids.append(doc_id)
                    flags.append(flag)
                    texts.append(text.lower())
                    size += len(text)
                    if size >= shape.block_bytes:
                        yield packed()
                        number += 1
                        ids, flags, texts, size = [], [], [], 0
        if ids:
            yield packed()

    return source.mapInArrow(run, _BLOCK)


def _texts(row: dict) -> list[bytes]:
    data, at, out = zlib.decompress(row["data"]), 0, []
    for n in row["lengths"]:
        out.append(data[at : at + n])
        at += n
    return out


def _parts(texts: list[bytes], limit: int):
    """Ranges of texts of about ``limit`` bytes; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def grams(texts: list[bytes], order: int):
    """(keys of the distinct windows, window -> number of its key, text of each window).

    A window is a byte, or the end mark, with the ``order`` bytes before it, in one number. The
    trie is walked down for all windows at once: a node and the next byte give the next node.
    """
    lead = bytes([EDGE]) * order
    joined = b"".join(lead + t + bytes([EDGE]) for t in texts)
    raw = np.frombuffer(joined, np.uint8)
    values = np.flatnonzero(np.bincount(raw, minlength=256))
    number = np.zeros(256, np.int64)
    number[values] = np.arange(values.size)
    code = number[raw]
    n = raw.size - order
    node, keys = code[:n], values.astype(np.int64)
    for j in range(1, order + 1):
        node = node * values.size + code[j : n + j]
        seen = np.zeros(keys.size * values.size, bool)
        seen[node] = True
        at = np.flatnonzero(seen)
        place = np.zeros(seen.size, np.int64)
        place[at] = np.arange(at.size)
        node = place[node]
        keys = keys[at // values.size] << 8 | values[at % values.size]
    lengths = np.array([len(t) for t in texts]) + order + 1
    owner = np.repeat(np.arange(len(texts)), lengths)[order:]
    # Windows that end in the marks before a text belong to no text.
    begin = np.repeat(np.cumsum(lengths) - lengths, lengths)[order:]
    real = np.arange(order, raw.size) - begin >= order
    return keys, node[real], owner[real]


def words_of(rows: DataFrame) -> DataFrame:
    """block, word and its count in the block's training texts, which may be 0."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts = _word_counts(_texts(row), row["trains"])
                columns = [pa.array(np.full(len(counts), row["block"], np.int64)),
                           pa.array(list(counts), pa.binary()),
                           pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "word", "n"])

    return rows.mapInArrow(run, "block long, word binary, n long")


def _word_counts(texts: list[bytes], trains: list[bool]) -> Counter:
    counts: Counter = Counter()
    for text, flag in zip(texts, trains):
        if flag:
            counts.update(text.split())
    for text, flag in zip(texts, trains):
        if not flag:
            for word in set(text.split()):
                counts[word] += 0
    return counts


def grams_of(rows: DataFrame, shape: Shape) -> DataFrame:
    """block, gram and its count in the block's training texts, which may be 0."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                texts, flags = _texts(row), np.array(row["trains"], bool)
                found = []
                for a, b in _parts(texts, shape.part_bytes):
                    keys, window, owner = grams(texts[a:b], shape.order)
                    held = np.bincount(window, minlength=keys.size) > 0
                    count = np.bincount(window[flags[a:b][owner]], minlength=keys.size)
                    found.append((keys[held], count[held]))
                keys, number = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                count = np.bincount(number, np.concatenate([c for _, c in found])).astype(np.int64)
                block = pa.array(np.full(keys.size, row["block"]))
                yield pa.RecordBatch.from_arrays(
                    [block, pa.array(keys), pa.array(count)], ["block", "gram", "n"])

    return rows.mapInArrow(run, "block long, gram long, n long")


def code_lengths(counted: DataFrame, order: int, stage) -> DataFrame:
    """gram and log10 of the probability of its last byte, for distinct grams with counts ``n``.

    The trie is one table per order: counts of (context, byte), and per context its total, its
    number of bytes and what the context one byte shorter has for those same bytes (``inherited``),
    which exclusion takes away. Grams with count 0 are asked for, not learned from.
    """
    def tail(j: int) -> Column:
        return F.col("gram").bitwiseAND(F.lit((1 << 8 * (j + 1)) - 1))

    tables, nodes = {}, {}
    level = stage(counted.filter("n > 0").select("gram", "n"), f"trie_{order}")
    for j in range(order, -1, -1):
        tables[j] = level
        level = stage(level.groupBy(tail(j - 1).alias("gram")).agg(F.sum("n").alias("n")),
                      f"trie_{j - 1}") if j else None
    for j in range(1, order + 1):
        shorter = tables[j - 1].select(F.col("gram").alias("tail"), F.col("n").alias("n_short"))
        nodes[j] = (
            tables[j].withColumn("tail", tail(j - 1)).join(shorter, "tail")
            .groupBy(F.shiftright("gram", 8).alias(f"context_{j}"))
            .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"),
                 F.sum("n_short").alias("inherited"))
        )
    root = tables[0].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                         F.count("*").alias("kinds")).first()

    asked = counted.select("gram").withColumns({
        "log": F.lit(0.0), "done": F.lit(False), "gone": F.lit(0).cast("long"),
        "gone_kinds": F.lit(0).cast("long")})
    for j in range(order, -1, -1):
        own = tables[j].select(F.col("gram").alias("tail"), F.col("n").alias("own"))
        if j < 2:  # at most 65,536 bytes after bytes, and 256 contexts
            own = F.broadcast(own)
        asked = asked.withColumn("tail", tail(j)).join(own, "tail", "left")
        if j:
            node = F.broadcast(nodes[j]) if j == 1 else nodes[j]
            asked = asked.withColumn(f"context_{j}", F.shiftright("tail", 8)).join(
                node, f"context_{j}", "left")
        else:
            asked = asked.withColumns({"total": F.lit(root.total), "kinds": F.lit(root.kinds),
                                       "inherited": F.lit(0).cast("long")})
        left, new = F.col("total") - F.col("gone"), F.col("kinds") - F.col("gone_kinds")
        known = ~F.col("done") & F.col("own").isNotNull()
        # A context whose every symbol is excluded by now, or that was never seen, is passed over.
        escapes = ~F.col("done") & F.col("own").isNull() & (left > 0)
        asked = asked.select(
            "gram",
            (F.col("log") + F.when(known, F.log10(F.col("own") / (left + new)))
             .when(escapes, F.log10(new / (left + new))).otherwise(0.0)).alias("log"),
            (F.col("done") | F.col("own").isNotNull()).alias("done"),
            F.coalesce("inherited", F.lit(0)).alias("gone"),
            F.coalesce("kinds", F.lit(0)).alias("gone_kinds"),
        )
    last = -F.log10(F.lit(256.0) - F.lit(root.kinds))
    return asked.select("gram", (F.col("log") + F.when(F.col("done"), 0.0).otherwise(last))
                        .alias("log"))


def scored(docs: DataFrame, trains: Column, stage, shape: Shape = Shape()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``score`` is log10 of the probability of the whole text, A-Z lower-cased, and its end under
    the trie learned from the rows where ``trains`` holds. ``base_score`` is that of its words and
    one end under add-one word frequencies of the same rows. A null text counts as empty and has
    one token, the end; repeated rows each count and are each scored; with nothing to learn from
    all bytes are equally likely. Extra columns are not read. A text longer than a block is a block
    of its own and is scored whole; a null doc_id is carried; an empty table gives no rows. The
    counts of a word are added up in one task, one row for each block that holds it.
    """
    held = stage(blocks(docs, trains, shape), "blocks")
    by_word = W.partitionBy("word")
    words = stage(
        words_of(held).repartition("word").select(
            "block", "word", "n", F.sum("n").over(by_word).alias("c"),
            (F.col("block") == F.min("block").over(by_word)).alias("first")), "words")
    ends = held.select(F.sum(F.aggregate(
        "trains", F.lit(0).cast("long"), lambda s, t: s + t.cast("long"))).alias("n")).first().n or 0
    got = words.agg(F.sum("n").alias("n"), F.count_if(F.expr("first AND c > 0")).alias("v")).first()
    n_train, distinct = (got.n or 0) + ends, got.v + (ends > 0)

    in_blocks = stage(grams_of(held, shape), "grams")
    counted = stage(in_blocks.groupBy("gram").agg(F.sum("n").alias("n")), "gram_counts")
    coded = stage(code_lengths(counted, shape.order, stage), "code_lengths")
    # A word of one block only has its count there already.
    word_rows = words.filter("c != n").select(
        "block", "word", F.lit(None).cast("long").alias("gram"), F.col("c").cast("double").alias("v"))
    gram_rows = in_blocks.select("block", "gram").join(coded, "gram").select(
        "block", F.lit(None).cast("binary").alias("word"), "gram", F.col("log").alias("v"))
    dictionary = word_rows.unionByName(gram_rows)
    schema = "doc_id long, n_tokens long, n_known long, base_sum double, score double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        is_gram = right.column("word").is_null()
        word_part = right.filter(pc.invert(is_gram))
        counts = dict(zip(word_part.column("word").to_pylist(), word_part.column("v").to_pylist()))
        gram_part = right.filter(is_gram)
        keys = gram_part.column("gram").to_numpy()
        order = np.argsort(keys)
        keys, logs = keys[order], gram_part.column("v").to_numpy()[order]
        columns = [[] for _ in range(5)]
        for row in left.to_pylist():
            texts = _texts(row)
            local = _word_counts(texts, row["trains"])
            for a, b in _parts(texts, shape.part_bytes):
                found, window, owner = grams(texts[a:b], shape.order)
                value = logs[np.minimum(np.searchsorted(keys, found), keys.size - 1)]
                score = np.bincount(owner, value[window], b - a)
                for i in range(a, b):
                    tokens = texts[i].split()
                    c = np.fromiter((counts.get(w, local[w]) for w in tokens), float, len(tokens))
                    columns[0].append(row["doc_ids"][i])
                    columns[1].append(len(tokens) + 1)
                    columns[2].append(int(np.count_nonzero(c)) + (ends > 0))
                    columns[3].append(float(np.log10(c + 1).sum() + np.log10(ends + 1)))
                    columns[4].append(float(score[i - a]))
        types = [pa.int64()] * 3 + [pa.float64()] * 2
        return pa.table([pa.array(v, t) for v, t in zip(columns, types)],
                        names=[part.split()[0] for part in schema.split(", ")])

    out = held.groupBy("block").cogroup(dictionary.groupBy("block")).applyInArrow(run, schema)
    floor = F.log10(F.lit(float(n_train + distinct + 1)))
    return out.select(
        "doc_id", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * floor).alias("base_score"), "score")
