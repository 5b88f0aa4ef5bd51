"""Token ids in files coded by a static range asymmetric numeral system. A segment holds whole
documents in order, one frequency table that all its blocks share, and blocks of a fixed number of
ids. Blocks are independent: each has its final state, the place of its words and a checksum, so a
reader can start at any of them, and numpy codes all blocks of a segment side by side, one id of
each per step."""

from __future__ import annotations

import hashlib
import struct
import sys
import unicodedata
import zlib
from array import array
from dataclasses import dataclass
from itertools import compress
from pathlib import Path
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HEAD = "<4sHHIQII"  # mark, version, bits, documents, ids, ids of a block, blocks
_MAGIC, _VERSION = b"rans", 1
_LOW = np.uint64(1 << 31)  # states lie in [2^31, 2^63), renormalised by 32-bit words
_WORD, _MASK = np.uint64(32), np.uint64(0xFFFFFFFF)


def _byte_signs() -> dict[int, str]:
    """Stand-ins of byte-level vocabularies: visible Latin-1 characters stand for their own byte,
    the other bytes in order for characters from 256 on. A blank is left as it is."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + i) for i, b in enumerate(hidden) if b != 32}


_BYTE_SIGNS = _byte_signs()


@dataclass(frozen=True)
class Layout:
    """Ids per block, and ids after which a segment is closed; a document is never split."""

    block: int = 1024
    segment: int = 4_000_000


def quantised(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2^bits, near the counts' shares."""
    total = 1 << bits
    f = np.maximum(1, counts * total // counts.sum())
    rest = total - int(f.sum())
    order = np.argsort(-f, kind="stable")
    if rest > 0:
        f[order[0]] += rest
    for i in order:
        if rest >= 0:
            break
        take = min(int(f[i]) - 1, -rest)
        f[i] -= take
        rest += take
    return f


def _starts(f: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(f)[:-1]])


def encode(ids: np.ndarray, doc_lengths: np.ndarray, block: int = Layout.block) -> bytes:
    """One segment: head, document lengths, frequency table, checkpoints, words."""
    ids = ids.astype(np.int64)
    counts = np.bincount(ids, minlength=1)
    symbols = np.flatnonzero(counts)
    bits = max(16, int(symbols.size).bit_length() + 2)
    n_blocks = -(-ids.size // block)
    if ids.size:
        f = quantised(counts[symbols], bits)
        number = np.zeros(counts.size, np.int64)
        number[symbols] = np.arange(symbols.size)
        grid = np.zeros(n_blocks * block, np.int64)
        grid[: ids.size] = number[ids]
        grid = np.ascontiguousarray(grid.reshape(n_blocks, block).T)
        freq, start = f.astype(np.uint64), _starts(f).astype(np.uint64)
        limit = freq << np.uint64(63 - bits)
        last = ids.size - (n_blocks - 1) * block
        state = np.full(n_blocks, _LOW)
        words = np.zeros((n_blocks, block * bits // 32 + 2), np.uint32)
        used = np.zeros(n_blocks, np.int64)
        shift = np.uint64(bits)
        for t in range(block - 1, -1, -1):
            # Only the last block can be short.
            lanes = n_blocks if t < last else n_blocks - 1
            s, x = grid[t, :lanes], state[:lanes]
            full = np.flatnonzero(x >= limit[s])
            words[full, used[full]] = x[full] & _MASK
            used[full] += 1
            x[full] >>= _WORD
            q, r = np.divmod(x, freq[s])
            state[:lanes] = (q << shift) + r + start[s]
        flat = words[np.arange(words.shape[1]) < used[:, None]]
        ends = np.cumsum(used)
        raw = ids.astype("<u4")
        sums = np.array([zlib.crc32(raw[i * block : (i + 1) * block]) for i in range(n_blocks)])
        marks = b"".join([state.astype("<u8").tobytes(), ends.astype("<u8").tobytes(),
                          sums.astype("<u4").tobytes()])
        table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes()
                              + f.astype("<u4").tobytes())
        body = flat.astype("<u4").tobytes()
    else:
        marks, table, body = b"", b"", b""
    lengths = zlib.compress(doc_lengths.astype("<u4").tobytes())
    head = struct.pack(_HEAD, _MAGIC, _VERSION, bits, doc_lengths.size, ids.size, block, n_blocks)
    sizes = struct.pack("<III", len(lengths), len(table), symbols.size)
    return head + sizes + lengths + table + marks + body


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and document lengths of a segment; a block with a wrong checksum is an error."""
    magic, version, bits, n_docs, n_ids, block, n_blocks = struct.unpack_from(_HEAD, data)
    if magic != _MAGIC or version != _VERSION:
        raise ValueError("not a segment of this format")
    at = struct.calcsize(_HEAD)
    n_lengths, n_table, n_symbols = struct.unpack_from("<III", data, at)
    at += 12
    lengths = np.frombuffer(zlib.decompress(data[at : at + n_lengths]), "<u4").astype(np.int64)
    at += n_lengths
    if lengths.size != n_docs or lengths.sum() != n_ids:
        raise ValueError("document lengths do not add up")
    if not n_ids:
        return np.empty(0, np.uint32), lengths
    table = np.frombuffer(zlib.decompress(data[at : at + n_table]), "<u4").astype(np.int64)
    at += n_table
    symbols, f = np.cumsum(table[:n_symbols]), table[n_symbols:]
    state = np.frombuffer(data, "<u8", n_blocks, at).astype(np.uint64)
    ends = np.frombuffer(data, "<u8", n_blocks, at + 8 * n_blocks).astype(np.int64)
    sums = np.frombuffer(data, "<u4", n_blocks, at + 16 * n_blocks)
    words = np.frombuffer(data, "<u4", offset=at + 20 * n_blocks).astype(np.uint64)
    slot_symbol = np.repeat(np.arange(n_symbols), f)
    freq, start = f.astype(np.uint64), _starts(f).astype(np.uint64)
    shift, low_bits = np.uint64(bits), np.uint64((1 << bits) - 1)
    grid = np.zeros((block, n_blocks), np.int64)
    last, place = n_ids - (n_blocks - 1) * block, ends - 1
    for t in range(block):
        lanes = n_blocks if t < last else n_blocks - 1
        x = state[:lanes]
        slot = x & low_bits
        s = slot_symbol[slot.astype(np.int64)]
        grid[t, :lanes] = s
        x = freq[s] * (x >> shift) + slot - start[s]
        short = np.flatnonzero(x < _LOW)
        x[short] = (x[short] << _WORD) | words[place[short]]
        place[short] -= 1
        state[:lanes] = x
    ids = symbols[grid.T.ravel()[:n_ids]].astype("<u4")
    found = [zlib.crc32(ids[i * block : (i + 1) * block]) for i in range(n_blocks)]
    if not np.array_equal(np.array(found, np.uint32), sums):
        raise ValueError("a block's checksum is wrong")
    return ids, lengths


class Words:
    """Ids of texts, each distinct word encoded once.

    Words between ASCII white space are cut further into the runs below, as the tokenizer cuts them
    before it looks inside; distinct runs go to it many at a time. That equals encoding the text
    whole, which tests check. Words that could differ (invisible characters, not in composed form, lower
    case of another length, a special token's mark, a capital soon behind an apostrophe: a
    contraction only where the tokenizer lower-cases) go to the tokenizer as they are.

    A run as a word has the same ids, so one table holds both; it is emptied once ``most`` are in it.
    Where the tokenizer lower-cases, A-Z of texts without a special token's mark are lower-cased first,
    so that fewer words differ.
    """

    RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
    CAPITAL = regex.compile(r"'\p{L}?\p{Lu}")

    def __init__(self, path: str, most: int = 1_600_000, content: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = (
            Tokenizer.from_file(path) if content is None else Tokenizer.from_str(content))
        self.most = most
        self.words: dict[bytes, bytes] = {}
        self._encoded = self._whole_runs
        self.lowers = self.tokenizer.normalizer is not None and (
            self.tokenizer.normalizer.normalize_str("ABCXYZ") == "abcxyz")
        probe = ["Abc", "é", "'s", "9", "?!", "ß", "漢字", "~", "ÀÑ"]
        if self.tokenizer.normalizer is not None:
            if self._byte_runs(probe) == self._whole_runs(probe):
                self._encoded = self._byte_runs

    def _learn_runs(self, runs: list[bytes]) -> None:
        # Those beyond ASCII apart, since only they need stand-ins for their bytes.
        plain = [run for run in runs if run.isascii()]
        for part in (plain, [run for run in runs if not run.isascii()]):
            for at in range(0, len(part), 20_000):
                some = part[at : at + 20_000]
                texts = b"\n".join(some).decode("utf-8", "replace").split("\n")
                for run, ids in zip(some, self._encoded(texts)):
                    self.words[run] = array("I", ids).tobytes()

    def _whole_runs(self, runs: list[str]) -> list[list[int]]:
        """Ids of each run by the whole tokenizer."""
        got = self.tokenizer.encode(runs, is_pretokenized=True, add_special_tokens=False)
        owner = np.array(got.word_ids, np.int64)
        cuts = np.searchsorted(owner, np.arange(len(runs) + 1)).tolist()
        return [got.ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _byte_runs(self, runs: list[str]) -> list[list[int]]:
        """The same for a byte-level tokenizer: its normaliser for all runs at once, its bytes'
        stand-ins, and its model for each run, without the bookkeeping of places in the text."""
        joined = self.tokenizer.normalizer.normalize_str(" ".join(runs))
        # Visible ASCII stands for itself.
        if not (joined.isascii() and joined.isprintable()):
            joined = joined.encode().decode("latin-1").translate(_BYTE_SIGNS)
        pieces = joined.split(" ")
        if len(pieces) != len(runs):
            return self._whole_runs(runs)
        tokenize = self.tokenizer.model.tokenize
        return [[t.id for t in tokenize(piece)] for piece in pieces]

    def _learn_whole(self, word: bytes, text: str) -> None:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        self.words[word] = array("I", ids).tobytes()

    @staticmethod
    def _plain(text: str) -> bool:
        return (text.isprintable() and "<|" not in text and len(text.lower()) == len(text)
                and (text.isascii() or unicodedata.is_normalized("NFC", text)))

    def _learn(self, new: list[bytes]) -> None:
        # Words hold no line end, so they are read and judged together; one by one only if need be.
        joined = b"\n".join(new).decode("utf-8", "replace")
        texts = joined.split("\n")
        if not self._plain(joined.replace("\n", " ")):
            fit = [self._plain(text) for text in texts]
            for word, text, plain in zip(new, texts, fit):
                if not plain:
                    self._learn_whole(word, text)
            new = list(compress(new, fit))
            texts = list(compress(texts, fit))
        # Most words are letters, with or without a sign behind them.
        letters = [text.isalpha() for text in texts]
        runs = dict.fromkeys(compress(new, letters))
        cut = []
        for word, text, alone in zip(new, texts, letters):
            if alone:
                continue
            if text[-1] in ".,;:!?" and text[:-1].isalpha():
                parts = (word[:-1], word[-1:])
            elif "'" in text and self.CAPITAL.search(text):
                self._learn_whole(word, text)
                continue
            else:
                parts = tuple([run.encode() for run in self.RUNS.findall(text)])
            cut.append((word, parts))
            runs.update(dict.fromkeys(parts))
        known = self.words
        self._learn_runs([run for run in runs if run not in known])
        for word, parts in cut:
            known[word] = b"".join([known[run] for run in parts])

    def _cut(self, text: bytes) -> list[bytes]:
        if self.lowers and b"<|" not in text:
            text = text.lower()
        return text.split()

    def __call__(self, texts: list[bytes], end: int) -> list[np.ndarray]:
        """Ids of each text, and the end id."""
        if len(self.words) > self.most:
            self.words.clear()
        cut = [self._cut(text) for text in texts]
        known, mark = self.words, np.array([end], "<u4").tobytes()
        new = set().union(*cut).difference(known)
        if new:
            self._learn(list(new))
        ids = known.__getitem__
        return [np.frombuffer(b"".join([*map(ids, ws), mark]), "<u4") for ws in cut]


def _words(path: str, content: str) -> Words:
    """The one of this Python worker, which outlives its tasks."""
    kept = sys.modules.setdefault("_worker_vocabularies", ModuleType("_worker_vocabularies"))
    name = hashlib.sha256(content.encode()).hexdigest()
    if name not in kept.__dict__:
        kept.__dict__[name] = Words(path, content=content)
    return kept.__dict__[name]


def write(docs: DataFrame, path: str, vocabulary: str, end: int = 1, layout: Layout = Layout()):
    """Writes the texts of ``docs`` (doc_id, text) as segments, in ascending doc_id order.

    Rows with the same doc_id lie in the order of their texts' bytes; a null doc_id comes first. A
    null text counts as empty and has the end id alone; a very long one is encoded whole, and closes
    its segment; repeated rows each count; an empty table gives files without segments; other columns
    are not read. One shuffle, of the texts, by ranges of doc_id and of the texts' first 16 bytes,
    so that rows without an id are spread too. ``vocabulary`` is a file that the driver reads; its
    content, of a fixed size, goes to the tasks.
    """
    if array("I").itemsize != 4 or sys.byteorder != "little":
        raise RuntimeError("ids are written as they lie in memory, in 4 bytes, the lowest first")
    content = Path(vocabulary).read_text(encoding="utf-8")
    order = F.col("doc_id").asc_nulls_first()
    ordered = (
        docs.select("doc_id", common.text_bytes("text").alias("text"))
        .repartitionByRange(order, F.substring("text", 1, 16))
        .sortWithinPartitions(order, "text")
    )
    schema = "part int, segment int, n_docs long, n_ids long, doc_ids array<long>, data binary"
    fields = ["part", "segment", "n_docs", "n_ids", "doc_ids", "data"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def run(batches):
        words, part = _words(vocabulary, content), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        doc_ids: list = []
        size = segment = 0

        def closed():
            nonlocal held, doc_ids, size, segment
            lengths = np.array([ids.size for ids in held])
            data = encode(np.concatenate(held), lengths, layout.block)
            row = [part, segment, len(doc_ids), size, doc_ids, data]
            held, doc_ids, size, segment = [], [], 0, segment + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)], fields)

        for batch in batches:
            for rows in common.slices(batch, 1024):
                found = words(rows.column(1).to_pylist(), end)
                for doc_id, ids in zip(rows.column(0).to_pylist(), found):
                    held.append(ids)
                    doc_ids.append(doc_id)
                    size += ids.size
                    if size >= layout.segment:
                        yield closed()
        if held:
            yield closed()

    ordered.mapInArrow(run, schema).write.mode("overwrite").parquet(path)


def read(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, decoded from the files.

    ``start`` counts all ids before the document: totals are summed per part, then per segment
    inside a part, so no task sees more rows than there are parts, or segments of one part.
    """
    files = spark.read.parquet(path)
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.join(parts, "part").select(
        "part", "segment",
        (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base"))
    schema = "part int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long"
    names = ["part", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = decode(row["data"])
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = lengths.size
                columns = [pa.array(np.full(n, row["part"], np.int32)),
                           pa.array(np.full(n, row["segment"], np.int32)),
                           pa.array(row["doc_ids"], pa.int64()), pa.array(starts),
                           pa.array(lengths), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    docs = files.select("part", "segment", "doc_ids", "data").mapInArrow(run, schema)
    return docs.join(bases, ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
