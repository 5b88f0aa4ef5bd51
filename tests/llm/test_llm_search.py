"""Repeated passages, phrases and spelling variants against plain rewrites on small fixtures."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from satmart.llm import phrases, queries, spelling_variants, suffix_repeats
from satmart.sources.storage import Stage


# Phrases


def plain_collocations(rows, how):
    """Candidates by counting every piece's windows, with Python's whole numbers."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c < "\x80" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, how.longest + 1):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, found in counts.items():
        good = {p: a for p, a in found.items() if len(p) > 1 and a >= how.least}
        kept = []
        for p, a in good.items():
            cuts = [(10**6 * a * a // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [b for q, b in good.items() if len(q) > len(p) and any(
                q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= how.within * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[: how.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found_collocations(spark, frame, rows, how):
    docs = frame([(i, text, lang, "x") for i, (lang, text) in enumerate(rows)],
                 "shard long, text string, lang string, word string")
    return sorted(map(tuple, phrases.collocations(docs, Stage(spark), how).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("longest, shard_bytes", [(2, 300), (3, 300), (3, 10**6), (5, 500)])
def test_collocations_equal_plain_counts(spark, frame, longest, shard_bytes):
    rng = random.Random(longest)
    words = ["the", "The", "a", "ÉTÉ", "été", "x y", "-", "\x00", "new", "york", " "]
    ends = [" ", "\t", "  ", ". ", ",", "\n", "\r\n", "; ", "\x0b", " "]
    rows = [(rng.choice(["en", "fr", None, ""]), "".join(
        rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60))))
        for _ in range(60)]
    rows += [("en", None), ("en", ""), ("de", "   "), ("es", "one two " * 3000)]
    how = phrases.Phrases(longest=longest, least=4, top=25, shard_bytes=shard_bytes)
    assert found_collocations(spark, frame, rows, how) == plain_collocations(rows, how)


def test_collocations_of_an_empty_table(spark, frame):
    assert found_collocations(spark, frame, [], phrases.Phrases()) == []
    assert found_collocations(spark, frame, [(None, None)], phrases.Phrases()) == []


def test_a_shard_gives_its_phrases_in_the_order_of_their_ids(spark, frame):
    rng = random.Random(8)
    words = {w: 7 * i for i, w in enumerate("edcba")}
    texts = [" ".join(rng.choices("abcde", k=80)) + "." for _ in range(4)]
    docs = frame([("en", text) for text in texts], "lang string, text string").coalesce(1)
    how = phrases.Phrases(shard_bytes=200)
    held = Stage(spark)(phrases.shards(docs, how), "shards")
    numbers = [r.shard for r in held.collect()]
    dictionary = frame([(n, w.encode(), i) for n in numbers for w, i in words.items()],
                       "shard long, word binary, id long")
    got = [tuple(r) for r in phrases.counted_phrases(
        held, dictionary, how).coalesce(1).collect()]
    plain = Counter()
    for text in texts:
        ids = [words[w] for w in text.rstrip(".").split()]
        for size in (2, 3):
            for i in range(len(ids) - size + 1):
                plain[tuple(ids[i : i + size] + [-1] * (3 - size))] += 1
    added = Counter()
    for *key, n in got:
        added[tuple(key)] += n
    assert added == plain
    # Rows of a shard rise; only where another one begins may they fall.
    assert len(numbers) > 1
    assert sum(a[:3] >= b[:3] for a, b in zip(got, got[1:])) < len(numbers)


def test_both_sides_of_an_index_stay_in_step():
    rng = np.random.default_rng(3)
    ids = np.concatenate([[0], rng.integers(0, 5, 400), [0]]).astype(np.int32)
    for rows, count in phrases.phrases_of(ids, 6):
        size = rows.shape[1]
        plain = Counter(
            tuple(ids[i : i + size].tolist()) for i in range(ids.size - size + 1)
            if ids[i : i + size].all())
        assert dict(zip(map(tuple, rows.tolist()), count.tolist())) == plain


# Spelling variants


def one_edit(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, how, every=97):
    total = Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if c < "\x80" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run
            if h % every == 0:
                at = h % len(run)
                word = run[:at] + run[at + 1 :]
            total[word] += 1
    n = {w: c for w, c in total.items() if len(w) >= how.least_length and c >= how.least_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= how.ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=lambda r: r[0])


def found_variants(spark, frame, rows, how, every=97):
    docs = frame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string")
    got = spelling_variants.grouped(docs, Stage(spark), how, every).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(map(tuple, got), key=lambda r: r[0])


@pytest.mark.parametrize("symbols, carried", [(8, 40), (2, 7), (3, 0)])
def test_variants_equal_plain_search(spark, frame, symbols, carried):
    rng = random.Random(symbols)
    letters = "abÀÿE"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(150):
        picked = []
        for _ in range(30):
            word = rng.choice(base[: rng.choice([5, 20, 60])])
            if rng.random() < 0.4:
                at = rng.randrange(len(word) + 1)
                word = word[:at] + rng.choice(["", rng.choice(letters)]) + word[at + rng.choice([0, 1]) :]
            picked.append(word)
        rows.append((rng.choice([i, 7, None]), rng.choice([" ", "-", "1"]).join(picked)))
    rows += [(1, None), (2, ""), (3, "12 --"), (5, "a" * 300 + " " + "a" * 299 + "b " + "a" * 301)]
    rows += [(6 + i, "a" * 300 + " " + "a" * 301) for i in range(4)]
    rows += [(20 + i, "b" * 6 + "a" * 40 + " " + "b" * 5 + "a" * 41 + " " + "b" * 5 + "a" * 40)
             for i in range(4)]
    rows += [(40 + i, " ".join(["chainaa"] * 9 + ["chainab"] * 3 + ["chaincb"])) for i in range(9)]
    how = spelling_variants.Variants(symbols=symbols, carried=carried)
    expected = plain_variants(rows, how, 5)
    assert sum(r[1] is not None for r in expected) > 20
    assert any(r[2] not in (r[0], r[1]) for r in expected)
    assert found_variants(spark, frame, rows, how, 5) == expected


def test_variants_of_an_empty_table(spark, frame):
    how = spelling_variants.Variants()
    assert found_variants(spark, frame, [], how) == []
    assert found_variants(spark, frame, [(1, "once"), (None, None)], how) == []


def test_variants_of_a_very_long_word(spark, frame):
    word = "ab" * 50_000
    rows = [(i, f"{word} {word}x") for i in range(3)]
    got = found_variants(spark, frame, rows, spelling_variants.Variants(), 10**9 + 7)
    assert [(r[3], r[4], r[1]) for r in got] == [(3, 1, None)] * 2


def test_neighbours_are_the_reduced_words_one_edit_away():
    rng = np.random.default_rng(1)
    signs = rng.integers(0, 3, (40, 6)).astype(np.uint64)
    made = {}
    for step in (1, 7, 1 << 18):
        keys = sorted((int(r), int(k)) for row, key in
                      spelling_variants.neighbour_keys(signs, 3, step) for r, k in zip(row, key))
        assert made.setdefault("all", keys) == keys
    for i, row in enumerate(signs):
        plain = {tuple(row)}
        for at, new in itertools.product(range(6), range(3)):
            if new > row[at]:
                plain.add((*row[:at], new, *row[at + 1 :]))
        plain |= {(*row[:at], *row[at + 1 :]) for at in range(6)}
        want = sorted(int(spelling_variants.own_keys(np.array([p], np.uint64))[0]) for p in plain)
        assert sorted(k for r, k in made["all"] if r == i) == want


# Repeated passages


def plain_repeats(texts, size):
    """Per text (spans, kept): every start's string counted over all texts."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + size] for t in raw for i in range(len(t) - size + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - size + 1):
            if count[t[i : i + size]] > 1:
                gone[i : i + size] = [True] * size
        spans, at = [], 0
        for value, run in itertools.groupby(gone):
            n = len(list(run))
            spans += [(at, at + n)] * value
            at += n
        out.append((len(t), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return out


def found_repeats(spark, frame, texts, how):
    docs = frame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, block long")
    rows = suffix_repeats.without_repeats(docs, Stage(spark), how).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    return [(r.n_bytes, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in rows]


@pytest.mark.parametrize("start, gram, short, block, part", [
    (10, 4, 3, 300, 64), (5, 3, 4, 1000, 1 << 20), (7, 5, 1, 1, 37), (16, 2, 2, 500, 1000),
])
def test_repeats_equal_plain_counts(spark, frame, start, gram, short, block, part):
    rng = random.Random(start)
    pool = ["".join(rng.choice("abcé") for _ in range(rng.randint(15, 60))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(pool) if rng.random() < 0.5 else "".join(
            rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))) for _ in range(4)]
        text = "".join(parts)
        if rng.random() < 0.5:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice("xyz") + text[at:]
        texts.append(text)
    texts += [None, "", "a" * 19, "b" * 20, "b" * 20, "c" * 21, "z" * 500, "xy" * 100, texts[0]]
    texts += ["".join(rng.choice("klm") for _ in range(3000))]
    how = suffix_repeats.Repeats(20, start, gram, short, block, part)
    assert found_repeats(spark, frame, texts, how) == plain_repeats(texts, 20)


def test_repeats_of_an_empty_table(spark, frame):
    assert found_repeats(spark, frame, [], suffix_repeats.Repeats()) == []
    assert found_repeats(spark, frame, [None], suffix_repeats.Repeats()) == [(0, [], b"")]


def test_repeats_of_the_table_equal_plain_counts(spark):
    rows = queries.QUERIES["op11_suffix_repeats"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    plain = plain_repeats([d.text for d in docs], 200)
    want = {d.doc_id: (n, sum(b - a for a, b in spans), len(spans),
                       hashlib.sha256(kept).hexdigest())
            for d, (n, spans, kept) in zip(docs, plain)}
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want
    assert sum(v[1] for v in want.values()) > 0
