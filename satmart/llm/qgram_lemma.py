"""Benchmark decontamination by q-gram lemma filtering. A region of a text within e edits of a
benchmark passage of m characters shares at least m - q + 1 - q * e character q-grams with it, on
diagonals (place in the text less place in the passage) at most e apart. Shared q-grams are counted
in overlapping bands of diagonals, bands that reach the bound are kept, and each is verified by an
alignment inside its band."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from satmart.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])


_BLANKS = {c: " " for c in range(0x3001) if chr(c).isspace()}


@dataclass(frozen=True)
class Match:
    """``q``; edits allowed per character; passages that an item is cut into, and their distance;
    characters of benchmark text that one pass over the documents looks for.

    Wherever it is cut out of its item, a copied run of ``passage`` + ``step`` - 1 characters holds
    a whole passage."""

    q: int = 12
    edits: float = 0.05
    passage: int = 80
    step: int = 20
    block_chars: int = 2_000_000


def folded(text: str) -> str:
    """Lower case, with every white space a blank, and of the same length."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.translate(_BLANKS)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q characters in a row, put together from halves."""
    odds = common.odd_numbers(64, 7)
    have, size, at, total = codes, 1, 0, None
    done = 0
    while q:
        if q & 1:
            n = codes.size - done - size + 1
            piece = have[done : done + max(n, 0)]
            total = piece if total is None else total[: piece.size] * odds[at + 32] + piece
            done += size
        q >>= 1
        if q:
            have = have[:-size] * odds[at] + have[size:] if have.size > size else have[:0]
            size, at = 2 * size, at + 1
    # Spread the low bits too.
    return (total ^ (total >> np.uint64(29))) * odds[63]


def passages(text: str, how: Match) -> list[str]:
    """The whole of a short item; overlapping passages of a long one, the last at its end."""
    if len(text) <= how.passage:
        return [text]
    starts = [*range(0, len(text) - how.passage, how.step), len(text) - how.passage]
    return [text[s : s + how.passage] for s in starts]


class Index:
    """q-grams of the distinct passages of one block of items."""

    BITS = 22

    def __init__(self, items: list[tuple[int, str]], how: Match):
        self.how = how
        known: dict[str, int] = {}
        self.items: list[Counter] = []  # per passage: item -> how often it holds it
        grams, owner, place = [], [], []
        for item_id, text in items:
            for passage in passages(folded(text), how):
                p = known.setdefault(passage, len(known))
                if p == len(self.items):
                    hashes = gram_hashes(_codes(passage), how.q)
                    owner.append(np.full(hashes.size, p, np.int32))
                    place.append(np.arange(hashes.size, dtype=np.int32))
                    grams.append(hashes)
                    self.items.append(Counter())
                self.items[p][item_id] += 1
        self.patterns = list(known)
        self.longest = max(map(len, known), default=0)
        empty = np.empty(0, np.int32)
        grams = np.concatenate([np.empty(0, np.uint64), *grams])
        order = np.argsort(grams, kind="stable")
        self.owner = np.concatenate([empty, *owner])[order]
        self.place = np.concatenate([empty, *place])[order]
        self.keys, self.first = np.unique(grams[order], return_index=True)
        self.count = np.diff(np.append(self.first, grams.size))
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[(self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
        m = np.array([len(p) for p in self.patterns], np.int64)
        self.edits = np.minimum((m * how.edits).astype(np.int64), (m - how.q) // how.q)
        self.bound = m - how.q + 1 - how.q * self.edits
        self.width = np.maximum(self.edits, 1)

    def hits(
        self, codes: np.ndarray, most: int = 2_000_000
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Place in the text, passage and place in the passage of every shared q-gram, about ``most``
        at a time: a q-gram that both repeat often gives as many as the product of both."""
        hashes = gram_hashes(codes, self.how.q)
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)])
        slot = np.searchsorted(self.keys, hashes[at])
        slot[slot == self.keys.size] = 0
        same = self.keys[slot] == hashes[at] if self.keys.size else np.zeros(0, bool)
        at, slot = at[same], slot[same]
        n = self.count[slot]
        part = np.cumsum(n) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), at.size]):
            if i < j:
                few, own = n[i:j], slot[i:j]
                posting = np.repeat(self.first[own] - np.cumsum(few) + few, few) + np.arange(
                    few.sum())
                yield np.repeat(at[i:j], few), self.owner[posting], self.place[posting]


def aligned(pattern: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Fewest edits between the pattern and any part of the region, and where that part ends."""
    column = np.arange(region.size + 1)
    row = np.zeros(region.size + 1, np.int64)
    for i, code in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (region != code))
        # A step along the region costs one: the least of everything to the left.
        row = np.minimum.accumulate(new - column) + column
    end = int(np.argmin(row))
    return int(row[end]), end


def _verified(index: Index, codes: np.ndarray, text: str, p: int, low: int, high: int):
    """(edits, start, end) of passage p in the text between low and high, or None."""
    low, high = max(low, 0), min(high, len(text))
    at = text.find(index.patterns[p], low, high)
    if at >= 0:
        return 0, at, at + len(index.patterns[p])
    if not index.edits[p]:
        return None
    pattern, region = _codes(index.patterns[p]), codes[low:high]
    edits, end = aligned(pattern, region)
    if edits > index.edits[p]:
        return None
    back = aligned(pattern[::-1], region[:end][::-1])[1]
    return edits, low + end - back, low + end


def matches(index: Index, texts: list[str], chars: int = 1_000_000) -> list[dict]:
    """Per text: item -> (fewest edits of a passage, start, end, passages found).

    Texts are looked at together, up to ``chars`` characters or one whole text at a time.
    """
    found, held, size = [], [], 0
    for text in texts:
        if held and size + len(text) > chars:
            found += _matches(index, held)
            held, size = [], 0
        held.append(text)
        size += len(text)
    return found + (_matches(index, held) if held else [])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, number = np.unique(keys, return_inverse=True)
    return keys, np.bincount(number, counts, keys.size).astype(np.int64)


def _matches(index: Index, texts: list[str]) -> list[dict[int, tuple[int, int, int, int]]]:
    texts = [folded(t) for t in texts]
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths + 1) - lengths - 1
    codes = _codes("\n".join(texts))  # no folded text holds a line end, so no q-gram spans two
    found: list[dict] = [{} for _ in texts]
    n_bands = 2 * int(lengths.max()) + 4 + 2 * index.longest
    shift = index.longest + 2
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for place, owner, offset in index.hits(codes):
        doc = np.searchsorted(starts, place, "right") - 1
        # Bands are two widths wide and a width apart: one of them holds any diagonals a width apart.
        lead = (place - starts[doc] - offset) // index.width[owner]
        key = (doc * len(index.patterns) + owner) * n_bands + lead + shift
        new, n = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        keys, counts = _summed(np.concatenate([keys, new]), np.concatenate([counts, n]))
    pair = keys // n_bands
    kept = np.flatnonzero(counts >= index.bound[pair % len(index.patterns)]) if keys.size else keys
    if not kept.size:
        return found
    # Bands next to each other are looked at together: a text that goes on and on has many.
    first = np.flatnonzero(np.concatenate(
        [[True], (np.diff(keys[kept]) > 1) | (np.diff(pair[kept]) != 0)]))
    last = np.append(first[1:], kept.size) - 1
    done: dict[tuple[int, int], tuple[int, int, int]] = {}
    for a, b in zip(keys[kept[first]].tolist(), keys[kept[last]].tolist()):
        (d, p), low, high = divmod(a // n_bands, len(index.patterns)), a % n_bands, b % n_bands
        if done.get((d, p), (1,))[0] == 0:
            continue
        w, e, m = int(index.width[p]), int(index.edits[p]), len(index.patterns[p])
        s = int(starts[d])
        own = codes[s : s + int(lengths[d])]
        got = _verified(
            index, own, texts[d], p, (low - shift) * w - e, (high - shift + 2) * w + m + e)
        if got is not None:
            done[d, p] = min(got, done.get((d, p), got))
    for (d, p), got in done.items():
        for item, times in index.items[p].items():
            old = found[d].get(item)
            n = (old[3] if old else 0) + times
            found[d][item] = (*(min(got, old[:3]) if old else got), n)
    return found


def item_blocks(items: DataFrame, how: Match):
    """The benchmark in blocks of about ``block_chars``, one at a time on the driver."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).filter(
        F.length("text") >= how.q)
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    n_blocks = max(1, -(-total // how.block_chars))
    for block in range(n_blocks):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        yield sorted((r.item_id, r.text) for r in part.collect())


def overlaps(
    docs: DataFrame, items: DataFrame, carry: list[str], text: str = "text", how: Match = Match()
) -> DataFrame:
    """``row`` (the carried columns) and ``found``: item_id, edits, start, stop and n_passages, a row
    for each document and item of which it holds a passage; other documents give no row.

    ``start`` and ``stop`` are characters of the document, those of the passage with the fewest
    edits, the first of such. Items under ``q`` characters, null and empty texts match nothing;
    repeated rows each give their rows, passages of a repeated item count each time; texts of any length are
    looked at whole; empty tables give no rows. The benchmark is looked for in blocks of bounded
    size, each in one pass over the documents, so a benchmark of any size is neither broadcast nor
    cut.
    """
    source = docs.select(
        common.row_of(carry), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    names = ["item_id", "edits", "start", "stop", "n_passages"]
    kind = StructType([StructField(n, LongType()) for n in names])
    schema = source.select("row").schema.add("found", kind)
    arrow = to_arrow_type(kind)

    def search(index: Index):
        def run(batches):
            for batch in batches:
                for part in common.slices(batch):
                    found = matches(index, part.column(1).to_pylist())
                    hits = [(i, dict(zip(names, (k, *v))))
                            for i, f in enumerate(found) for k, v in sorted(f.items())]
                    rows = part.column(0).take(pa.array([i for i, _ in hits], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [rows, pa.array([v for _, v in hits], arrow)], ["row", "found"])
        return run

    result = None
    for block in item_blocks(items, how):
        one = source.mapInArrow(search(Index(block, how)), schema)
        result = one if result is None else result.unionAll(one)
    return result


def keep_clean(
    docs: DataFrame, items: DataFrame, text: str = "text", how: Match = Match()
) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage of any item, with their own columns.

    Null and empty texts stay, repeated rows go or stay together, texts of any length are looked at
    whole; without items all rows stay."""
    source = docs.select("*")
    for block in item_blocks(items, how):
        source = _without(source, Index(block, how), text)
    return source


def _without(docs: DataFrame, index: Index, text: str) -> DataFrame:
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for part in common.slices(batch):
                found = matches(index, [t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array([not f for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
