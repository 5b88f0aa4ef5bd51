"""Near duplicates by DartMinHash. Each element throws darts at its region (weight by rank): the
ranks of its darts are a Poisson process drawn from a hash of the element alone, so equal elements
throw equal darts in every text. A signature keeps, per coordinate, the dart of the lowest rank;
two texts agree in a coordinate with the probability of their weighted Jaccard similarity. Only
darts of low rank are drawn, about k * (log k + 3) for a text, whatever its length."""

from __future__ import annotations

import hashlib
import sys
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satmart.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Near:
    """Words of a shingle, least similarity, bands and rows of a band, weights of shingles.

    With 40 bands of 5 rows a pair of similarity 0.8 shares no band once in eight million times.
    ``weights`` is ``set`` (each distinct shingle 1) or ``count`` (its occurrences).
    """

    words: int = 5
    similarity: float = 0.8
    bands: int = 40
    rows: int = 5
    weights: str = "set"
    leader_rounds: int = 2
    rare_rounds: int = 1


class _WordHashes(dict):
    def __missing__(self, word):
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def elements(texts: list[bytes], how: Near) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes of each text, and their weights.

    A text of one to four words is one shingle; a text without words has none.
    """
    cut = [t.split() for t in texts]
    sizes = [len(ws) for ws in cut]
    known = _WordHashes()
    flat = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.uint64, sum(sizes))
    odds = common.odd_numbers(how.words, 11)
    out, at = [], 0
    for n in sizes:
        words = flat[at : at + n]
        at += n
        if n >= how.words:
            shingles = np.zeros(n - how.words + 1, np.uint64)
            for j in range(how.words):
                shingles += words[j : j + shingles.size] * odds[j]
        elif n:
            shingles = np.array([(words * odds[:n]).sum() + np.uint64(n)], np.uint64)
        else:
            shingles = words
        found, counts = np.unique(common.mix(shingles), return_counts=True)
        weights = counts.astype(float) if how.weights == "count" else np.ones(found.size)
        out.append((found, weights))
    return out


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64 random bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """One row of k dart ids per non-empty weighted set; weights may be any positive numbers."""
    out = np.zeros((len(sets), k), np.uint64)
    todo = [i for i, (found, _) in enumerate(sets) if found.size]
    highest = {i: k * (np.log(k) + 3) / sets[i][1].sum() for i in todo}
    while todo:
        filled = _throw([sets[i] for i in todo], np.array([highest[i] for i in todo]), k)
        done = filled[0].all(axis=1)
        for row, i in enumerate(todo):
            out[i] = filled[1][row]
            highest[i] *= 2
        # A coordinate without a dart so far needs darts of higher rank.
        todo = [i for row, i in enumerate(todo) if not done[row]]
    return out


def _throw(sets, highest: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    # A region of weight w is cut into ceil(w) cells of weight 1; darts beyond w miss.
    owner = np.repeat(np.arange(len(sets)), [f.size for f, _ in sets])
    keys = np.concatenate([f for f, _ in sets])
    weight = np.concatenate([w for _, w in sets])
    cells = np.ceil(weight).astype(np.int64)
    if cells.size and cells.max() > 1:
        cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        owner, keys = np.repeat(owner, cells), np.repeat(keys, cells)
        room = np.repeat(weight, cells) - cell
        keys = common.mix(keys + cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    else:
        room = weight
    limit = highest[owner]
    rank = np.zeros(keys.size)
    darts = []
    throw = 0
    while keys.size:
        throw += 1
        dart = common.mix(keys + np.uint64(throw * 0xD1B54A32D192ED03 % (1 << 64)))
        rank = rank - np.log(_uniform(dart))
        near = rank <= limit
        keys, owner, limit, rank, room = (v[near] for v in (keys, owner, limit, rank, room))
        dart = common.mix(dart[near] ^ np.uint64(0x2545F4914F6CDD1D))
        hit = _uniform(common.mix(dart + np.uint64(1))) <= room
        darts.append((owner[hit], dart[hit], rank[hit]))
    owner, dart, rank = (np.concatenate(v) for v in zip(*darts))
    order = np.argsort(-rank, kind="stable")  # of darts at one place the last, lowest one stays
    place = (owner * k + (dart % np.uint64(k)).astype(np.int64))[order]
    least = np.zeros(len(sets) * k, np.uint64)
    seen = np.zeros(len(sets) * k, bool)
    least[place], seen[place] = dart[order], True
    return seen.reshape(-1, k), least.reshape(-1, k)


def band_keys(signed: np.ndarray, how: Near) -> np.ndarray:
    odds = common.odd_numbers(how.rows, 13)
    parts = signed.reshape(len(signed), how.bands, how.rows)
    keys = (parts * odds).sum(axis=2, dtype=np.uint64) + np.arange(how.bands, dtype=np.uint64)
    return common.mix(keys).view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact weighted Jaccard similarity of two sorted weighted sets."""
    common_keys, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - shared
    return float(shared / whole) if whole else 0.0


def sketches(docs: DataFrame, text: str, how: Near) -> DataFrame:
    """doc_id, copy_key (a digest of the words, null without words) and bands of each row."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         common.text_bytes(text).alias("text"))
    names = ["doc_id", "copy_key", "bands"]

    def run(batches):
        for batch in batches:
            for part in common.slices(batch):
                texts = part.column(1).to_pylist()
                sets = elements(texts, how)
                bands = band_keys(signatures(sets, how.bands * how.rows), how)
                keys = [hashlib.md5(b" ".join(t.split())).digest() if s[0].size else None
                        for t, s in zip(texts, sets)]
                values = pa.array([b if k else None for k, b in zip(keys, bands)],
                                  pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.binary()), values], names)

    return source.mapInArrow(run, "doc_id long, copy_key binary, bands array<long>")


def similar(pairs: DataFrame, texts: DataFrame, how: Near) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) really have the similarity asked for."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        for batch in batches:
            for part in common.slices(batch, 64):
                sides = [part.column(i).to_pylist() for i in (2, 3)]
                distinct = {t: i for i, t in enumerate(dict.fromkeys(chain(*sides)))}
                sets = elements(list(distinct), how)
                near = [similarity(sets[distinct[x]], sets[distinct[y]]) >= how.similarity
                        for x, y in zip(*sides)]
                yield part.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, stage) -> DataFrame:
    """id and label, the least id of its component, for every id in ``edges`` (a, b).

    Labels spread along edges and are then followed once more, so long chains take few turns. Each
    turn is written; only the number of changes comes to the driver.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        reached = both.join(labels, both.b == labels.id).groupBy("a").agg(
            F.min("label").alias("reached"))
        spread = labels.join(reached, labels.id == reached.a).select(
            "id", "label", F.least("label", "reached").alias("nearer"))
        onward = labels.select(F.col("id").alias("nearer"), F.col("label").alias("onward"))
        new = stage(spread.join(onward, "nearer", "left").select(
            "id", F.least("nearer", "onward").alias("label"),
            (F.least("nearer", "onward") != F.col("label")).alias("changed")), "labels")
        labels = new.select("id", "label")
        if new.filter("changed").isEmpty():
            return labels


def _compared(members: DataFrame, texts: DataFrame, state: dict, turns: int, stage, how: Near):
    """Links found by comparing each text of a bucket (id, bucket) with leaders, turn by turn.

    The leader is the least id; a text already in its class is not compared. Buckets whose texts are
    in one class by then are settled; the others go on without their leader. Returns the buckets
    that are left after the turns. ``state`` holds the edges found so far and the labels they give.
    """
    remaining = members
    for _ in range(turns):
        open_ = _unsettled(remaining, state, stage)
        if open_.isEmpty():
            return open_
        own = open_.filter("id = leader").select("bucket", F.col("label").alias("leader_label"))
        pairs = open_.filter("id > leader").join(own, "bucket").filter(
            "label != leader_label").select(F.col("leader").alias("a"), F.col("id").alias("b"))
        _link(pairs, texts, state, stage, how)
        remaining = open_.filter("id > leader").select(*members.columns)
    return _unsettled(remaining, state, stage)


def _unsettled(members: DataFrame, state: dict, stage) -> DataFrame:
    """id, bucket, label and leader of the buckets that hold texts of several classes."""
    labelled = members.withColumn("label", F.col("id"))
    if state["labels"] is not None:
        labelled = members.join(state["labels"], "id", "left").withColumn(
            "label", F.coalesce("label", "id"))
    leaders = labelled.groupBy("bucket").agg(
        F.min("id").alias("leader"), F.min("label").alias("low"), F.max("label").alias("high")
    ).filter("low < high").select("bucket", "leader")
    return stage(labelled.join(leaders, "bucket").select(*members.columns, "label", "leader"), "open")


def _link(pairs: DataFrame, texts: DataFrame, state: dict, stage, how: Near) -> None:
    found = stage(similar(pairs.distinct(), texts, how), "links")
    if found.isEmpty():
        return
    state["edges"] = found if state["edges"] is None else state["edges"].union(found)
    state["labels"] = components(state["edges"], stage)


def rare_buckets(texts: DataFrame, how: Near, stage, common_from: int = 16) -> DataFrame:
    """id, bucket, rest and weight: the rarest shingles of each text, as many as a similar text
    cannot all lack, with what a shingle and those after it weigh, and the whole text's weight.

    Two sets of similarity t share an element among the first n - ceil(t * n) + 1 of each, in any
    order that both follow. Here shingles in fewer than ``common_from`` texts come first, by hash,
    then the others by their number, so texts that share nothing but common passages do not meet.
    Weights other than ``set`` are held within the same bound, by the weight of what is left out.
    """
    source = texts.select("id", common.text_bytes("text").alias("text"))

    def listed(batches):
        for batch in batches:
            for part in common.slices(batch):
                ids = part.column(0).to_pylist()
                for doc_id, (keys, _) in zip(ids, elements(part.column(1).to_pylist(), how)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(keys.size, doc_id, np.int64)),
                         pa.array(keys.view(np.int64))], ["id", "bucket"])

    shingles = source.mapInArrow(listed, "id long, bucket long")
    often = stage(shingles.groupBy("bucket").agg(F.count("*").alias("n"))
                  .filter(F.col("n") >= common_from), "common_shingles")
    held = shingles.join(often, "bucket").groupBy("id").agg(
        F.collect_list("bucket").alias("common"), F.collect_list("n").alias("n"))
    both = source.join(held, "id", "left")

    def first(batches):
        for batch in batches:
            for part in common.slices(batch):
                sets = elements(part.column(1).to_pylist(), how)
                columns = (part.column(i).to_pylist() for i in (0, 2, 3))
                for doc_id, names, counts, (keys, weights) in zip(*columns, sets):
                    known = dict(zip(names or [], counts or []))
                    number = [known.get(k, 0) for k in keys.view(np.int64).tolist()]
                    order = np.lexsort((keys, np.array(number, np.int64)))
                    left = weights[order][::-1].cumsum()[::-1]
                    # An element counts while what it and its successors weigh could suffice.
                    whole = weights.sum()
                    kept = left >= how.similarity * whole - 1e-9
                    n = int(kept.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, doc_id, np.int64)),
                         pa.array(keys[order][kept].view(np.int64)), pa.array(left[kept]),
                         pa.array(np.full(n, whole, np.float64))], names_out)

    names_out = ["id", "bucket", "rest", "weight"]
    return both.mapInArrow(first, "id long, bucket long, rest double, weight double")


def may_be_similar(how: Near) -> Column:
    """Whether two texts can share enough, if a shingle is the first that they share.

    Sets of weights x and y with similarity t share at least t / (1 + t) * (x + y), all of it in
    what each has from the shared shingle on. The first shared shingle of a similar pair always
    meets this, so no pair is lost.
    """
    share = how.similarity / (1 + how.similarity)
    return F.least("rest", "rest_b") >= share * (F.col("weight") + F.col("weight_b")) - 1e-9


def classes(docs: DataFrame, stage, text: str = "text", how: Near = Near()) -> DataFrame:
    """doc_id, copy_of and class_id for every row of ``docs``.

    ``copy_of`` is the least doc_id among rows with the same words; ``class_id`` is the least
    doc_id that a row is linked to through pairs of at least the similarity. Links are looked for
    between different texts only, one text for each group of copies.

    Texts that share a band are first compared with leaders, so a group of many near copies costs
    few comparisons a text. What shares a band and is not in one class after some turns is mostly
    texts with a passage in common: those meet again by their rarest shingles only, which loses no
    similar pair, with leaders first and then pair by pair, texts of different classes only.

    Texts without words, null ones included, are classes of their own. doc_id is taken for a key:
    rows that repeat it are one document. Extra columns are not read. Texts of any length are
    compared whole; an empty table gives no rows.
    """
    signed = stage(sketches(docs, text, how), "sketches")
    reps = stage(
        signed.filter(F.col("copy_key").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("copy_key")
        .agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "texts")
    exploded = reps.select("id", F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stage(exploded.join(shared.select("bucket"), "bucket").distinct(), "members")
    texts = _texts(docs, members, text, stage)
    state = {"edges": None, "labels": None}
    open_ = _compared(members, texts, state, how.leader_rounds, stage, how)
    if not open_.isEmpty():
        left = texts.join(open_.select("id").distinct(), "id", "left_semi")
        rare = rare_buckets(stage(left, "open_texts"), how, stage)
        open_ = _compared(stage(rare, "rare"), texts, state, how.rare_rounds, stage, how)
        other = open_.select(
            "bucket", F.col("id").alias("b"), F.col("label").alias("label_b"),
            F.col("rest").alias("rest_b"), F.col("weight").alias("weight_b"))
        pairs = open_.join(other, "bucket").filter("id < b AND label != label_b").filter(
            may_be_similar(how))
        if not open_.isEmpty():
            _link(pairs.select(F.col("id").alias("a"), "b"), texts, state, stage, how)
    known = signed.select("doc_id", "copy_key").join(
        reps.select("copy_key", F.col("id").alias("copy_of")), "copy_key", "left")
    out = known.select("doc_id", F.coalesce("copy_of", "doc_id").alias("copy_of"))
    if state["labels"] is None:
        return out.withColumn("class_id", F.col("copy_of"))
    return out.join(state["labels"].withColumnRenamed("id", "copy_of"), "copy_of", "left").select(
        "doc_id", "copy_of", F.coalesce("label", "copy_of").alias("class_id"))


def _texts(docs: DataFrame, members: DataFrame, text: str, stage) -> DataFrame:
    """id and text of the texts that share a bucket with another one."""
    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       common.text_bytes(text).alias("text"))
    held = rows.join(wanted, "doc_id", "left_semi")
    return stage(held.select(F.col("doc_id").alias("id"), "text"), "candidate_texts")


def keep_one(docs: DataFrame, stage, text: str = "text", how: Near = Near()) -> DataFrame:
    """One row of each class, that with the least doc_id, with its own columns.

    Of rows that repeat a doc_id one stays; rows without doc_id all stay.
    """
    found = stage(classes(docs, stage, text, how), "classes")
    kept = found.filter("doc_id = class_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    once = docs.join(kept.filter("n = 1").select("doc_id"), "doc_id", "left_semi")
    several = docs.join(kept.filter("n > 1").select("doc_id"), "doc_id", "left_semi")
    nameless = docs.filter(F.col("doc_id").isNull())
    return (once.unionAll(several.dropDuplicates(["doc_id"])).unionAll(nameless)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
