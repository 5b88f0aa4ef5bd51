"""Spelling variants: words one edit apart. Letters are hashed to a few symbols; the neighbours of a
reduced word, made in full, are joined with the reduced vocabulary, and the pairs that meet are
verified on the words as written. Each edit is made from one side only: a letter taken away by the
longer word, a symbol replaced by a larger one, and the reduced word itself for letters that share a
symbol; so a pair meets once."""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satmart.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


@dataclass(frozen=True)
class Variants:
    """Symbols of the reduced alphabet; code points and occurrences that a word needs; a word's
    form has at least ``ratio`` times its count; up to how many code points a word travels with its
    own keys (a longer one travels as a digest); words held before a task hands on their counts."""

    symbols: int = 8
    least_length: int = 5
    least_count: int = 3
    ratio: int = 2
    carried: int = 40
    held: int = 300_000


def typed(run: str, crc: int, every: int) -> str:
    """The run, less one letter where ``every`` divides its number."""
    if crc % every:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def counted_words(docs: DataFrame, how: Variants = Variants(), every: int = 97) -> DataFrame:
    """word and n, its occurrences in whole texts, for the words that are long and frequent enough.

    Words are runs of Latin letters, A-Z lower-cased. Every ``every``-th pair of document and run,
    by the crc32 of ``<doc_id>:<run>``, is counted without one of its letters. A null text has no
    words, a null doc_id counts as empty; repeated rows each count; other columns are not read.
    """
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        common.text_bytes("text").alias("text"))

    def run(batches):
        total: Counter = Counter()

        def handed():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                ["word", "n"])

        for batch in batches:
            for part in common.slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    lead = zlib.crc32(f"{doc_id}:".encode())
                    runs = Counter(_RUN.findall(text.lower().decode("utf-8", "replace")))
                    for found, n in runs.items():
                        word = typed(found, zlib.crc32(found.encode(), lead), every)
                        if len(word) >= how.least_length:
                            total[word] += n
                    if len(total) > how.held:
                        yield handed()
                        total.clear()
        if total:
            yield handed()

    counts = source.mapInArrow(run, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= how.least_count)


_BASE = int(common.odd_numbers(1, 13)[0])
_BACK = pow(_BASE, -1, 1 << 64)


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """The symbols of words of one length, a row each."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    hashed = common.mix(codes + np.uint64(1)) >> np.uint64(32)
    return (hashed % np.uint64(symbols)).astype(np.uint64).reshape(len(words), -1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(_BASE))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _key(value: np.ndarray, length: int) -> np.ndarray:
    salt = np.uint64(length * 0x9E3779B97F4A7C15 % (1 << 64))
    return common.mix(value + salt).view(np.int64)


def own_keys(signs: np.ndarray) -> np.ndarray:
    """One number per reduced word."""
    return _key((signs * _powers(signs.shape[1])).sum(1, dtype=np.uint64), signs.shape[1])


def neighbour_keys(
    signs: np.ndarray, symbols: int, step: int = 1 << 18
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of the word, number) of the reduced words made from each: itself, each symbol replaced by
    a larger one, each symbol taken away; ``step`` symbols of the words at a time.

    Taking away either of two equal neighbouring symbols gives the same word, made once."""
    rows, m = signs.shape
    power = _powers(m)
    terms = signs * power
    value = terms.sum(1, dtype=np.uint64)
    upto = np.cumsum(terms, 1, dtype=np.uint64)
    yield np.arange(rows), _key(value, m)
    width = max(1, step // rows)
    for a in range(0, m, width):
        b = min(a + width, m)
        cut = signs[:, a:b]
        for by in range(1, symbols):
            row, at = np.nonzero(cut + np.uint64(by) < symbols)
            yield row, _key(value[row] + np.uint64(by) * power[a + at], m)
        after = signs[:, a + 1 : b + 1]
        last = cut[:, : after.shape[1]] != after
        if b == m:
            last = np.concatenate([last, np.ones((rows, 1), bool)], 1)
        row, at = np.nonzero(last)
        at += a
        before = upto[row, at] - terms[row, at]
        rest = (value[row] - upto[row, at]) * np.uint64(_BACK)
        yield row, _key(before + rest, m - 1)


def _keyed(words: DataFrame, how: Variants, asks: bool) -> DataFrame:
    """key, name and n: of the neighbours of each word where ``asks``, else of the word itself.

    Takes name, word and n."""
    def of_one_length(table: pa.RecordBatch):
        signs = reduced(table.column("word").to_pylist(), how.symbols)
        found = neighbour_keys(signs, how.symbols) if asks else [
            (np.arange(signs.shape[0]), own_keys(signs))]
        for row, keys in found:
            if row.size:
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), table.column("name").take(at), table.column("n").take(at)],
                    ["key", "name", "n"])

    def run(batches):
        for batch in batches:
            words_ = batch.column(batch.schema.get_field_index("word"))
            lengths = np.array([len(w) for w in words_.to_pylist()], np.int64)
            for m in np.unique(lengths):
                at = np.flatnonzero(lengths == m)
                # A long word is looked at alone, short ones some thousand at a time.
                each = max(1, min(4096, (1 << 18) // int(m)))
                for i in range(0, at.size, each):
                    yield from of_one_length(batch.take(pa.array(at[i : i + each])))

    return words.select("name", "word", "n").mapInArrow(run, "key long, name string, n long")


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by one letter, in time of their length."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) > len(a) + 1:
        return False
    x, y = (np.frombuffer(w.encode("utf-32-le"), "<u4") for w in (a, b))
    differ = np.flatnonzero(x != y[: x.size])
    at = int(differ[0]) if differ.size else x.size
    return a[at + 1 :] == b[at + 1 :] if x.size == y.size else a[at:] == b[at + 1 :]


def _verified(pairs: DataFrame) -> DataFrame:
    """The pairs of long words that are one edit apart; the built-in distance takes time of the square
    of a word's length."""
    def run(batches):
        for batch in batches:
            for part in common.slices(batch):
                words = [part.column(part.schema.get_field_index(c)).to_pylist() for c in "ab"]
                yield part.filter(pa.array(list(map(one_edit, *words)), pa.bool_()))

    return pairs.mapInArrow(run, pairs.schema)


def near_words(vocabulary: DataFrame, how: Variants = Variants()) -> DataFrame:
    """word, n, other, other_n for every two words that are one edit apart, once for each of them.

    Short words travel with their keys, so that a pair is verified where it meets. A longer one has
    a key for each of its letters, so its digest travels and the words meet again afterwards.
    """
    def met(words: DataFrame, condition=None) -> DataFrame:
        asked = _keyed(words, how, True).select("key", F.col("name").alias("a"),
                                                F.col("n").alias("a_n"))
        held = _keyed(words, how, False).select("key", F.col("name").alias("b"),
                                                F.col("n").alias("b_n"))
        on = asked["key"] == held["key"]
        return asked.join(held, on if condition is None else on & condition).select(
            "a", "a_n", "b", "b_n")

    length = F.length("word")
    short = vocabulary.filter(length <= how.carried).withColumn("name", F.col("word"))
    pairs = met(short, F.levenshtein("a", "b", 1) == 1)
    long = vocabulary.filter(length >= how.carried).withColumn("name", F.sha2("word", 256))
    texts = long.select("name", "word")
    met_again = (
        met(long, F.col("a") != F.col("b"))
        .join(texts.toDF("a", "a_word"), "a").join(texts.toDF("b", "b_word"), "b")
        .filter(F.greatest(F.length("a_word"), F.length("b_word")) > how.carried)
        .select(F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n")
    )
    far = _verified(met_again)
    # Two words with the same reduced word meet from both sides, others once.
    ends = [F.struct(F.col(c).alias("word"), F.col(f"{c}_n").alias("n")) for c in ("a", "b")]
    once = pairs.unionByName(far).select(
        F.least(*ends).alias("x"), F.greatest(*ends).alias("y")).distinct()
    both = once.select(F.explode(F.array(F.struct("x", "y"), F.struct(
        F.col("y").alias("x"), F.col("x").alias("y")))).alias("p"))
    return both.select("p.x.word", "p.x.n", F.col("p.y.word").alias("other"),
                       F.col("p.y.n").alias("other_n"))


def grouped(docs: DataFrame, stage, how: Variants = Variants(), every: int = 97) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``counted_words``.

    ``form`` is the most frequent near word (ties: the least in code-point order) if it has at
    least ``ratio`` times the count, else null; ``root`` is the last word on the way of forms, the
    word itself without any. Counts at least double on each step, so ways are short; they are
    followed by joining the table with itself, twice as far each time. An empty table has no words;
    a word of any length is looked at whole.
    """
    vocabulary = stage(counted_words(docs, how, every), "vocabulary")
    # At most one near word per place and letter: no group grows with the corpus.
    near = near_words(vocabulary, how).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
        .alias("best"))
    frequent = -F.col("best.minus") >= how.ratio * F.col("n")
    words = stage(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("best.form")).alias("form"),
            F.when(frequent, -F.col("best.minus")).alias("form_n")), "forms")
    ways = words.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("end"))
        ways = stage(
            ways.join(further, "root", "left").select(
                "word", F.coalesce("end", "root").alias("root"),
                F.col("end").isNotNull().alias("moved")), "roots")
        if ways.filter("moved").isEmpty():
            break
        ways = ways.drop("moved")
    return words.join(ways.drop("moved"), "word", "left").withColumn(
        "root", F.coalesce("root", "word"))
