"""Near duplicates, packing, coded files, chat windows and the q-gram filter against plain rewrites,
and the pipeline."""

import difflib
import hashlib
import itertools
import random
import re
import resource
import zlib

import numpy as np
import public_tokenizers
import pytest
from compare import connect, difference
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from satmart.llm import (
    chat_windows, dart_minhash, gam, length_buckets, oracle, qgram_lemma, queries, rans,
)
from satmart.sources.storage import Stage

SF = "/root/testdata/sf0.01"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def jaccard(a, b):
    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x and y else 0.0


def plain_classes(texts):
    label = {i: i for i in texts}
    pairs = [(a, b) for a, b in itertools.combinations(sorted(texts), 2)
             if jaccard(texts[a], texts[b]) >= 0.8]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def near_copies(seed, n_groups=6, n_copies=9):
    """Groups whose copies drift: each is made from an earlier one, so links form chains."""
    draw = random.Random(seed)
    texts = []
    for g in range(n_groups):
        group = [[f"w{draw.randrange(3000)}" for _ in range(120)]]
        for _ in range(n_copies):
            words = list(draw.choice(group))
            for _ in range(draw.randrange(1, 4)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(9999)}"
            group.append(words)
        texts += [" ".join(w) for w in group]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("rounds", [0, 2])
def test_classes_equal_brute_force(spark, frame, rounds):
    texts = near_copies(rounds)
    texts += [texts[0], texts[0] + " ", "one", "one", "one two three", "", " ", None]
    docs = frame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, label int")
    how = dart_minhash.Near(leader_rounds=rounds, rare_rounds=rounds // 2)
    got = {r.doc_id: r.class_id for r in dart_minhash.classes(docs, Stage(spark), how=how).collect()}
    assert got == plain_classes({i: t or "" for i, t in enumerate(texts)})
    kept = dart_minhash.keep_one(docs.union(docs), Stage(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_classes_of_whole_table_equal_brute_force_on_links(spark):
    """Every class of the test table: its members hang together by links found pair by pair."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.class_id for r in queries.op3_dart_minhash(spark, SF).collect()}
    assert got == plain_classes_by_index({r.doc_id: r.text for r in rows})


def plain_classes_by_index(texts):
    """As plain_classes, with candidates from a full index of shingles."""
    index, sizes = {}, {}
    for i, t in texts.items():
        w = t.split()
        held = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        sizes[i] = len(held)
        for s in held:
            index.setdefault(s, []).append(i)
    shared = {}
    for ids in index.values():
        for pair in itertools.combinations(sorted(ids), 2):
            shared[pair] = shared.get(pair, 0) + 1
    label = {i: i for i in texts}
    near = [p for p, n in shared.items() if n / (sizes[p[0]] + sizes[p[1]] - n) >= 0.8]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_empty_and_nameless_documents(spark, frame):
    docs = frame([(None, "a b c d e f"), (None, "a b c d e f"), (3, None)], "doc_id long, text string")
    assert dart_minhash.classes(docs, Stage(spark)).count() == 3
    assert dart_minhash.keep_one(docs, Stage(spark)).count() == 3
    assert dart_minhash.classes(docs.limit(0), Stage(spark)).count() == 0


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(5)
    keys = draw.integers(1, 1 << 63, 300, dtype=np.uint64)
    keys.sort()
    a = keys, draw.uniform(0.2, 4, 300)
    b = keys, a[1] * draw.uniform(0.5, 1.2, 300)
    k = 4000
    signed = dart_minhash.signatures([a, b, (keys[:0], a[1][:0])], k)
    assert abs((signed[0] == signed[1]).mean() - dart_minhash.similarity(a, b)) < 0.03
    assert not signed[2].any()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), max_size=7), st.integers(1, 5))
def test_boundaries_are_optimal(histogram, buckets):
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[v] for v in sorted(histogram)], np.int64)

    def cost(ends):
        return sum(n * (min(e for e in ends if e >= v) - v) for v, n in histogram.items())

    got = length_buckets.boundaries(lengths, counts, buckets)
    assert len(got) <= buckets and got == sorted(set(got))
    if histogram:
        top = max(histogram)
        options = (c + (top,) for n in range(buckets)
                   for c in itertools.combinations([v for v in histogram if v != top], n))
        assert cost(got) == min(map(cost, options))


def test_packing_keeps_every_token(spark, frame):
    draw = random.Random(8)
    texts = ["w " * draw.randrange(0, 90) for _ in range(300)] + [None, "", "w " * 1000]
    docs = frame([(i, t, 0) for i, t in enumerate(texts)] + [(5, texts[5], 0), (None, "a", 0)],
                 "doc_id long, text string, batch int")
    shape = length_buckets.Shape(longest=64, buckets=4, batch_tokens=200, shard_rows=20)
    rows = length_buckets.packed(docs, length_buckets.word_tokens(), Stage(spark), shape).collect()
    want = sum(len((t or "").split()) + 1 for t in [*texts, texts[5], "a"])
    assert sum(r.n_tokens for r in rows) == want
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)
    lows = {}
    for r in rows:
        assert r.n_tokens + r.padding == r.bucket_length and r.padding >= 0
        lows.setdefault(r.bucket, []).append((r.batch, r.slot))
    for bucket, places in lows.items():
        length = next(r.bucket_length for r in rows if r.bucket == bucket)
        full = max(1, 200 // length)
        assert sorted(places) == [(i // full, i % full) for i in range(len(places))]
    long = sorted((r.piece, r.start, r.n_tokens) for r in rows if r.doc_id == 302)
    assert [p[1] for p in long] == [64 * p[0] for p in long] and sum(p[2] for p in long) == 1001
    assert length_buckets.packed(docs.limit(0), length_buckets.word_tokens(), Stage(spark)).count() == 0


def test_places_follow_ids_in_any_number_of_ranges(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    shape = length_buckets.Shape(shard_rows=40)
    for part in (docs, docs.repartition(7, "text")):
        df = length_buckets.packed(part, length_buckets.word_tokens(), Stage(spark), shape)
        assert difference(df, connect(SF), oracle.SQL["op4_length_buckets"]) is None
    draw = random.Random(2)
    rows = [(draw.choice([None, 3, 3, 3, *range(90)]), "w " * draw.randrange(40)) for _ in range(400)]
    shape = length_buckets.Shape(longest=16, buckets=3, batch_tokens=50, shard_rows=25)
    got = []
    for part in (rows, rows[::-1]):
        df = length_buckets.packed(frame(part, "doc_id long, text string").repartition(5),
                                   length_buckets.word_tokens(), Stage(spark), shape)
        got.append(sorted(df.collect(), key=lambda r: (r.bucket, r.batch, r.slot)))
    assert got[0] == got[1]
    key = [(r.bucket, r.doc_id is None, r.doc_id or 0, r.piece, r.n_tokens) for r in got[0]]
    assert key == sorted(key)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 70_000), max_size=40), max_size=12), st.integers(1, 9))
def test_segments_round_trip(documents, block):
    lengths = np.array([len(d) for d in documents], np.int64)
    ids = np.array([i for d in documents for i in d], np.uint32)
    got, sizes = rans.decode(rans.encode(ids, lengths, block))
    assert got.tolist() == ids.tolist() and sizes.tolist() == lengths.tolist()


def test_damaged_block_is_found():
    ids = np.arange(5000, dtype=np.uint32) % 91
    data = bytearray(rans.encode(ids, np.array([5000]), 512))
    data[-9] ^= 4
    with pytest.raises(ValueError, match="checksum"):
        rans.decode(bytes(data))
    skewed = np.where(np.arange(20_000) % 50, 7, 8)
    assert len(rans.encode(skewed, np.array([20_000]))) < 1500


TRICKY = ["it's  they're'd ''s x's\ty", "a<|endoftext|>b <|x", "ΣΑΣ İstanbul ǅ ﬁ ½ 12½", "e\u0301 \u0301x",
          "a\u00a0b\u2003c\x1cd\x85e", "don't we'll I'm O'Neil's", "\u200b\ufeffz", "漢字 かな 🙂🙂", "a\x00b",
          "DON'T O'Smith, D'Souza (O'Sullivan) O'Toole. O'Malley's IT'S WE'LL YOU'RE I'VE I'M SHE'D ''S"]


def test_words_equal_whole_texts():
    words = rans.Words(VOCABULARY)
    got = words([t.encode() for t in TRICKY] * 2, 1)
    want = [words.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in TRICKY] * 2
    assert [g.tolist() for g in got] == want


def test_capitals_behind_apostrophes_equal_whole_texts():
    words = rans.Words(VOCABULARY)
    ends = "s S t T m M d D re rE Re RE ve vE Ve VE ll lL Ll LL n N é É rÉ".split()
    texts = [f"{a}'{b}{c}" for a in ("", "O", "(x", "9'", "don't") for b in ends
             for c in ("", "mith", "MITH", "!", "'T")]
    got = words([t.encode() for t in texts], 1)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids + [1], text


def test_token_files_equal_direct_encoding(spark, frame, workdir):
    texts = [*TRICKY, None, "", "q w e " * 3000]
    docs = frame([(7 * i % 12, t, 0) for i, t in enumerate(texts)] + [(3, "same id", 0)],
                 "doc_id long, text string, part int")
    layout = rans.Layout(block=64, segment=500)
    rans.write(docs.repartition(4), workdir, VOCABULARY, layout=layout)
    got = sorted(rans.read(spark, workdir).collect(), key=lambda r: r.start)
    encode = rans.Words(VOCABULARY).tokenizer.encode
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    at = 0
    for (doc_id, text), r in zip(rows, got, strict=True):
        ids = np.array(encode(text, add_special_tokens=False).ids + [1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, ids.size, zlib.crc32(ids))
        at += ids.size
    rans.write(docs.limit(0), f"{workdir}/none", VOCABULARY)
    assert rans.read(spark, f"{workdir}/none").count() == 0


SAID = ["</s>[INST] ok [/INST]", "\\</s>\\\\", "<\\/s>", "<<s>s>", "[[INST]\\[/INST]", "a\nb", "", None,
        "w " * 200, "few words here", "[/INST]\n<s>", "\\"]


def test_windows_give_back_every_turn(spark, frame):
    draw = random.Random(4)
    rows = []
    for conv in range(25):
        start = [(conv, 0, "system", draw.choice(["be kind", "", "w " * 150]))] * (conv % 2)
        rows += start + [
            (conv, i + 1, draw.choice(["user", "assistant", "tool\nx", "<s>", None]),
             draw.choice(SAID + ["w " * draw.randrange(90)])) for i in range(draw.randrange(1, 30))]
    rows += [rows[3], (None, 1, "assistant", "lost"), (77, None, "user", "no turn")]
    turns = frame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, span string")
    budget = chat_windows.Budget(window=200, history=40, turn=60)
    windows = Stage(spark)(chat_windows.windows(turns, budget), "w")
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    got = {r.conv_id: r for r in chat_windows.read_back(windows).collect()}
    assert set(got) == set(by)
    for conv, said in by.items():
        said.sort()
        loss = "".join(t for _, role, t in said if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for _, role, t in said)
        assert got[conv].n_turns == len(said)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss)
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for r in windows.collect():
        marks = re.findall(r"<s>.*?</s>", r.formatted, re.S)
        assert len(marks) == r.n_repeated + r.n_fresh and "".join(marks) == r.formatted
        said = by[r.conv_id]
        if said[0][1] == "system":
            assert marks[0] == f"<s>system\n{chat_text(said[0][2])}</s>"
        assert r.over_budget == (r.n_tokens > 200)
        system = len(said[0][2].split()) + 4 if said[0][1] == "system" else 0
        if r.over_budget:  # only where turns do not fit beside the system turn
            assert r.n_fresh == 1 or system > 200 - 40 - 60
    assert chat_windows.read_back(chat_windows.windows(turns.limit(0))).count() == 0


def chat_text(text):
    return text.replace("\\", "\\\\")


def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_overlaps_equal_alignment_of_everything(spark, frame):
    draw = random.Random(6)

    def words(n):
        return " ".join("".join(draw.choice("aeiourstln") for _ in range(draw.randrange(1, 8)))
                        for _ in range(n))

    items = [words(draw.randrange(8, 30)) for _ in range(12)] + ["short", "", None]
    texts = []
    for _ in range(60):
        item = list(draw.choice(items[:12]))
        for _ in range(draw.randrange(0, 12)):
            at = draw.randrange(len(item))
            item[at : at + 1] = draw.choice([[], ["q"], [item[at], "q"]])
        texts.append(words(20) + " " + "".join(item).upper() + "\n" + words(10))
    texts += [words(50), "", None, items[0], items[0] + "\n\t " + items[1]]
    docs = frame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, found int")
    bench = frame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    for how in (qgram_lemma.Match(), qgram_lemma.Match(block_chars=300)):
        rows = qgram_lemma.overlaps(docs, bench, ["doc_id"], how=how).select(
            "row.doc_id", "found.*").collect()
        got = {(r.doc_id, r.item_id): r.edits for r in rows}
        assert len(got) == len(rows)  # one row per document and item, in however many blocks
        want = {}
        for (d, text), (i, item) in itertools.product(enumerate(texts), enumerate(items[:12])):
            near = [(edit_distance_inside(p, qgram_lemma.folded(text or "")), len(p))
                    for p in qgram_lemma.passages(qgram_lemma.folded(item), how)]
            best = [e for e, m in near if e <= min(int(m * how.edits), (m - 12) // 12)]
            if best:
                want[d, i] = min(best)
        assert got == want
        kept = qgram_lemma.keep_clean(docs, bench, how=how)
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert qgram_lemma.overlaps(docs.limit(0), bench, ["doc_id"]).count() == 0
    assert qgram_lemma.overlaps(docs, bench.limit(0), ["doc_id"]).count() == 0


def longest_shared_run(a, b):
    return difflib.SequenceMatcher(None, a, b, autojunk=False).find_longest_match().size


def test_copies_cut_anywhere_are_found():
    """Against the longest run of characters that two texts share: no passages are asked."""
    draw = random.Random(12)

    def letters(n):
        return "".join(draw.choice("aeiourstln ") for _ in range(n))

    sizes = [150, 240] + [draw.randrange(99, 420) for _ in range(14)]
    items = [(i, letters(n)) for i, n in enumerate(sizes)]
    cuts = [(0, 25, 125), (1, 20, 220)]
    for _ in range(70):
        i = draw.randrange(len(items))
        start = draw.randrange(sizes[i] - 60)
        cuts.append((i, start, draw.randrange(start + 60, sizes[i] + 1)))
    texts = [letters(50) + items[i][1][a:b].upper() + letters(draw.randrange(60)) for i, a, b in cuts]
    edited = []
    for i, a, b in cuts:  # every 30th character is another one
        run = "".join("#" if k % 30 == 17 else c for k, c in enumerate(items[i][1][a:b]))
        edited.append(letters(30) + run + letters(30))
    index = qgram_lemma.Index(items, qgram_lemma.Match())
    for text, found in zip(texts, qgram_lemma.matches(index, texts)):
        shared = {i: longest_shared_run(text.lower(), item) for i, item in items}
        assert {i for i, n in shared.items() if n >= 99} <= set(found)
        assert all(shared[i] >= 15 for i in found)  # four edits leave such a run of 80 characters
    for (i, a, b), found in zip(cuts, qgram_lemma.matches(index, edited)):
        assert set(found) <= {i} and (b - a < 99 or i in found)


def test_places_and_numbers_of_passages_equal_alignment():
    draw = random.Random(21)

    def letters(n):
        return "".join(draw.choice("aeiourstln ") for _ in range(n))

    items = [(i, letters(draw.randrange(60, 200))) for i in range(8)] + [(8, "ab" * 70)]
    items.append((9, items[0][1]))
    how, texts = qgram_lemma.Match(), []
    for _ in range(30):
        item = list(draw.choice(items)[1])
        for _ in range(draw.randrange(0, 5)):
            at = draw.randrange(len(item))
            item[at : at + 1] = draw.choice([[], ["#"], [item[at], "#"]])
        texts.append(letters(30) + "".join(item) + letters(20))
    index = qgram_lemma.Index(items, how)
    for text, found in zip(texts, qgram_lemma.matches(index, texts)):
        want = {}
        for i, item in items:
            allowed = [(p, min(int(len(p) * how.edits), (len(p) - how.q) // how.q))
                       for p in qgram_lemma.passages(item, how)]
            near = [(edit_distance_inside(p, text), p) for p, e in allowed
                    if edit_distance_inside(p, text) <= e]
            if near:
                want[i] = (min(e for e, _ in near), len(near))
        assert {i: (v[0], v[3]) for i, v in found.items()} == want
        for i, (edits, start, stop, _) in found.items():
            near = [edit_distance_inside(p, text[start:stop])
                    for p in qgram_lemma.passages(dict(items)[i], how)]
            assert min(near) == edits and (edits or text[start:stop] in dict(items)[i])


def test_a_character_that_goes_on_and_on():
    """An item of dashes against a million of them, and one of nearly dashes: all within bounds."""
    items = [(1, "-" * 400), (2, "-" * 76 + "x y="), (3, "=" * 60)]
    index = qgram_lemma.Index(items, qgram_lemma.Match())
    assert len(index.patterns) == 3
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got, none = qgram_lemma.matches(index, ["a" + "-" * 1_000_000, "-" * 40 + "=" * 50])
    assert got[1][:3] == (0, 1, 81) and got[1][3] == 17 and got[2][0] == 4 and set(got) == {1, 2}
    assert none == {}
    assert qgram_lemma.matches(index, ["b" + "-" * 12 + "c", "", "x" * 30]) == [{}, {}, {}]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # KB


def test_benchmark_items_are_found_in_the_test_table(spark):
    got = {(r.doc_id, r.item_id) for r in queries.op7_qgram_lemma(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    assert {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text} <= got


def test_pipeline_stages_hand_on_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage, kept = Stage(spark), docs
    seen = [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = stage(step(spark, kept, SF), name)
        assert kept.columns == docs.columns
        seen.append(kept.count())
    assert seen == sorted(seen, reverse=True) and len(set(seen)) == 5
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == seen[-1]


def plain_rules_keep(text):
    words = re.findall("[^ \t-\r]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search("[^ \t-\r]", line)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    repeated = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(8)}
    n, chars = len(words), sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return not (
        n < 20 or 100 * len(repeated) > 30 * n or 10 * symbols > 3 * n
        or 100 * (len(lines) - len(set(lines))) > 50 * len(lines) or chars < 2 * n or chars > 15 * n)


def nearest(pattern, text):
    """Fewest edits between the pattern and any part of the text, a row of the table at a time."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    row, column = np.zeros(codes.size + 1, int), np.arange(codes.size + 1)
    for i, c in enumerate(pattern, 1):
        new = np.append(i, np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c))))
        row = np.minimum.accumulate(new - column) + column
    return row.min()


def test_pipeline_equals_plain_stages(spark, workdir):
    """Every stage on what the one before it kept, worked out by plain means."""
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    model = queries.quality_model(spark, sf_dir)
    ids = sorted(docs)
    scores = gam.score(model, np.array([gam.features_of((docs[i] or "").encode()) for i in ids]))
    kept = {i: docs[i] for i, s in zip(ids, scores) if s >= 0.5}
    kept = {i: t for i, t in kept.items() if plain_rules_keep(t)}
    classes = plain_classes({i: t or "" for i, t in kept.items()})
    kept = {i: t for i, t in kept.items() if classes[i] == i}
    how = qgram_lemma.Match()
    items = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    patterns = {p for item in items if len(item) >= how.q
                for p in qgram_lemma.passages(qgram_lemma.folded(item), how)}

    def clean(text):
        low = qgram_lemma.folded(text or "")
        allowed = ((p, min(int(len(p) * how.edits), (len(p) - how.q) // how.q)) for p in patterns)
        # Without a run of q characters in common no passage is within its edits.
        grams = {low[i : i + how.q] for i in range(len(low) - how.q + 1)}
        return not any(
            p in low or any(p[i : i + how.q] in grams for i in range(len(p) - how.q + 1))
            and nearest(p, low) <= e for p, e in allowed)

    kept = {i: t for i, t in kept.items() if clean(t)}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    tokens = {}
    for r in rows:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.n_tokens
        assert r.n_tokens <= r.bucket_length and r.padding == r.bucket_length - r.n_tokens
    words = {i: len(re.findall("[^ \t-\r]+", t or "")) for i, t in kept.items()}
    assert tokens == {i: n + 1 for i, n in words.items()}  # and the end
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)
    assert 0 < len(kept) < len(docs)


def test_pipeline_on_edge_rows(spark, frame):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, score int"
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, None, None, None, 1, 2), (2, "", "", "", 0, 1, 2), (None, text, "en", "s", 1, None, 2)]
    for docs in (frame(rows * 2, schema), frame([], schema)):
        for _, step in corpus_pipeline.STAGES[:-1]:
            assert step(spark, docs, SF).columns == docs.columns
            step(spark, docs, SF).count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
