"""Rule ledger, byte-context scores, classifiers and host reputation against plain rewrites."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from satmart.llm import common, gam, host_reputation, nnpu, ppm, quality_rules
from satmart.sources.storage import Stage

SF = "/root/testdata/sf0.01"
CLASHING = "doc_id long, text string, row string, n_words string, score string, word string"


def texts_with_edges():
    long = " ".join(f"w{i % 7919}" for i in range(30_000))
    return [None, "", " \t\n", "one", "a b c\na b c\n\n a b c", long, "ß é 漢字 \u00a0x", "x" * 5000,
            "rest of it " * 40, "rest of it " * 40]


@pytest.fixture
def edges(frame):
    rows = [(i, t, None, "n", "s", None) for i, t in enumerate(texts_with_edges())]
    return frame([*rows, rows[-1], (None, "no id", None, None, None, None)], CLASHING)


def repeats(words):
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(grams)
    return len({i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(8)})


def test_repeat_words_equal_plain_count():
    draw = random.Random(3)
    for size in (0, 7, 8, 9, 30, 200):
        for letters in ("a", "ab", "abcdefgh"):
            words = [draw.choice(letters).encode() for _ in range(size)]
            assert quality_rules._repeat_words(words) == repeats(words)


def test_ledger_keeps_every_row(edges):
    got = quality_rules.ledger(edges, edges.columns).collect()
    assert len(got) == edges.count()
    by_id = {r.row.doc_id: r for r in got}
    assert by_id[0].n_words == by_id[1].n_words == by_id[2].n_words == 0
    assert by_id[0].fail_bits == 1
    assert (by_id[4].n_words, by_id[4].n_lines, by_id[4].n_dup_lines) == (9, 3, 1)
    assert (by_id[6].n_words, by_id[6].word_chars) == (4, 6)
    assert by_id[9].fail_bits & 2 and by_id[9].row.n_words == "n"
    assert quality_rules.keep_good(edges).columns == edges.columns
    assert quality_rules.ledger(edges.limit(0), ["doc_id"]).count() == 0


def test_ablations_count_what_a_rule_does(frame):
    book = frame([(0,), (1,), (1,), (3,), (2,), (0,)], "fail_bits long")
    policy = quality_rules.BASE
    got = {r.rule: r for r in quality_rules.ablations(book, policy).collect()}
    few, rep = got["few_words"], got["repeated_windows"]
    assert (few.n_failed, few.n_failed_alone, few.n_kept_without, few.n_kept) == (3, 2, 4, 2)
    assert (rep.n_failed, rep.n_failed_alone, rep.n_kept_without) == (2, 1, 3)


def plain_ppm(train, text, order):
    """log10 of the probability of a text, symbol by symbol over dictionaries."""
    counts = {}
    edge = bytes([ppm.EDGE])
    for t in train:
        raw = edge * order + t + edge
        for i in range(order, len(raw)):
            for k in range(order + 1):
                counts.setdefault(raw[i - k : i], Counter())[raw[i]] += 1
    raw, total = edge * order + text + edge, 0.0
    for i in range(order, len(raw)):
        gone = set()
        for k in range(order, -1, -1):
            node = {s: c for s, c in counts.get(raw[i - k : i], {}).items() if s not in gone}
            if not node:
                continue
            whole = sum(node.values()) + len(node)
            if raw[i] in node:
                total += math.log10(node[raw[i]] / whole)
                break
            total += math.log10(len(node) / whole)
            gone |= set(node)
        else:
            total -= math.log10(256 - len(gone))
    return total


@pytest.mark.parametrize("order", [1, 2, 4])
def test_byte_context_scores_equal_plain_model(spark, frame, order):
    draw = random.Random(order)
    texts = ["".join(draw.choice("abé \n") for _ in range(draw.randrange(40))) for _ in range(30)]
    texts += [None, "", "zzz Q", "ABA aba", "ABA aba"]
    docs = frame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, block string")
    held = F.col("doc_id") % 3 == 1
    # Small blocks, so that words and grams meet from several of them.
    shape = ppm.Shape(order=order, block_bytes=100, part_bytes=40)
    got = {r.doc_id: r for r in ppm.scored(docs.repartition(3), ~held, Stage(spark), shape).collect()}
    assert len(got) == len(texts)
    low = [(t or "").encode().lower() for t in texts]
    train = [t for i, t in enumerate(low) if i % 3 != 1]
    tokens = Counter(w for t in train for w in [*t.split(), "end"])
    n, v = sum(tokens.values()), len(tokens)
    for i, text in enumerate(low):
        c = [tokens[w] for w in [*text.split(), "end"]]
        assert (got[i].n_tokens, got[i].n_known) == (len(c), sum(x > 0 for x in c))
        assert got[i].train_tokens == n
        assert got[i].base_score == pytest.approx(sum(math.log10((x + 1) / (n + v + 1)) for x in c))
        assert got[i].score == pytest.approx(plain_ppm(train, text, order), abs=1e-9)


def test_byte_context_scores_of_a_very_long_text_and_without_ids(spark, frame):
    long = " ".join(f"w{i % 311}" for i in range(20_000))
    rows = [(1, long), (2, "short one"), (None, "w1 w2"), (None, None), (2, "short one")]
    docs = frame(rows, "doc_id long, text string")
    shape = ppm.Shape(order=2, block_bytes=50_000, part_bytes=9_000)
    got = ppm.scored(docs, F.lit(True), Stage(spark), shape).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [
        (0, 1), (0, 3), (1, 20_001), (2, 3), (2, 3)]
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    assert all(r.score < 0 and r.train_tokens == 20_011 for r in got)


def test_byte_context_scores_with_nothing_to_learn(spark, frame):
    docs = frame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.scored(docs, F.lit(False), Stage(spark)).collect()}
    assert got[1].score == pytest.approx(-3 * math.log10(256))
    assert (got[2].n_tokens, got[2].n_known, got[2].train_tokens) == (1, 0, 0)
    assert ppm.scored(docs.limit(0), F.lit(True), Stage(spark)).count() == 0


def held_out(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of == 1


def balanced(rows, truth, of=3):
    """Mean of the shares found right among held-out ones and among held-out zeros."""
    hits = {0: [], 1: []}
    for r in rows:
        if held_out(r.doc_id, of) and r.doc_id in truth:
            hits[truth[r.doc_id]].append(r.predicted == truth[r.doc_id])
    return np.mean([np.mean(h) for h in hits.values()])


@pytest.mark.parametrize("query, label", [("op10_gam_quality", "quality"), ("op8_nnpu_toxicity", "toxic")])
def test_classifiers_on_held_out_labels(spark, query, label):
    from satmart.llm import queries

    rows = queries.QUERIES[query](spark, SF).collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == held_out(r.doc_id, 3) for r in rows)
    assert balanced(rows, truth) > 0.85


def test_additive_model_finds_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (draw.random(4000) < 0.05)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert np.mean((gam.score(model, x[3000:]) >= 0.5) == y[3000:]) > 0.85
    assert gam.score(gam.fit(x[:0], y[:0]), x[:2]).tolist() == [0.5, 0.5]
    assert gam.fit(x[:9], np.ones(9)).tables == []


def test_positive_unlabelled_risk_separates_without_negatives():
    draw = np.random.default_rng(2)
    n = 3000
    toxic = draw.random(n) < 0.2
    hits = [np.flatnonzero(draw.random(6) < ([0.8, 0.8, 0.1, 0.1, 0.1, 0.1] if t else 0.1))
            for t in toxic]
    positive = toxic & (draw.random(n) < 0.3)
    share = toxic[~positive].mean()
    weights, bias = nnpu.fit(hits, positive, 6, share, nnpu.Fit())
    z = np.array([weights[h].sum() + bias for h in hits])
    rest = ~positive
    assert np.mean((z[rest] > 0) == toxic[rest]) > 0.9


def test_classifiers_score_edge_rows(spark, edges, frame):
    labels = frame([(8, 0), (5, 1), (7, None), (99, 1), (None, 1)], "doc_id long, label int")
    model = gam.train(edges, labels)
    rows = gam.scored(edges, model, edges.columns).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 for r in rows)
    assert gam.keep_good(edges, model).columns == edges.columns
    toxic = labels.withColumnRenamed("label", "toxic")
    model = nnpu.train(edges, toxic, F.lit(True), Stage(spark))
    assert nnpu.scored(edges, model, ["doc_id"]).count() == edges.count()
    nothing = edges.limit(0)
    model = nnpu.train(nothing, toxic.limit(0), F.lit(True), Stage(spark))
    assert nnpu.scored(nothing, model, ["doc_id"]).count() == 0


def test_fold_is_crc32_of_the_id(frame):
    got = frame([(i,) for i in range(50)], "doc_id long").select(
        "doc_id", common.fold(F.col("doc_id"), 7).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 7 for r in got)


def test_host_and_rules(spark, frame):
    urls = [
        ("http://WWW.Example.ORG/es/x?y#z", "www.example.org", "/es/x", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://myexample.org/es/", "myexample.org", "/es/", "org/", "allow"),
        ("x://a.com?p=://b.org/", "a.com", "", None, "allow"),
        ("a://b\nc.com/fr/1", "b\nc.com", "/fr/1", "com/fr/", "allow"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("example.org/es/", "", "", None, "allow"), (None, "", "", None, "allow"), ("://", "", "", None, "allow"),
    ]
    pages = frame([(i, u[0], "h") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    rules = host_reputation.rules_of(
        "allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")
    none = frame([], "page_id long, bad int")
    got = host_reputation.judge(pages, none, rules, Stage(spark)).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.page_id][1:]


def test_reputation_of_sites_under_other_suffixes(spark, frame):
    """Ports and users are no part of a site, and the suffixes under which names are registered are
    given; null urls, null ids and clashing columns are judged too."""
    bad = [(i, f"http://a{i}.spam.com.mx:80{i % 10}/") for i in range(60)]
    good = [(i, f"http://u@h{i}.fine.com.mx/") for i in range(60, 160)]
    new = [(900, "http://new.spam.com.mx/"), (901, "http://x@new.fine.com.mx:99/"), (None, None)]
    rows = [(*r, "site", "host") for r in bad + good + new]
    pages = frame(rows, "page_id long, url string, site string, host string")
    outcomes = frame([(i, int(i < 60), 1) for i in range(160)], "page_id long, bad int, host int")
    got = {r.page_id: r for r in host_reputation.judge(
        pages, outcomes, (), Stage(spark), two_label=("com.mx",)).collect()}
    assert len(got) == 163
    assert got[900].verdict == got[5].verdict == "block"
    assert got[901].verdict == got[70].verdict == "allow"
    assert got[901].host == "x@new.fine.com.mx:99" and got[None].host == ""
    assert host_reputation.judge(pages.limit(0), outcomes, (), Stage(spark)).count() == 0


def test_reputation_shrinks_to_the_domain(spark, frame):
    good = [(i, f"http://h{i % 9}.fine.net/") for i in range(400)]
    bad = [(i, f"http://h{i % 3}.spam.net/") for i in range(400, 520)]
    new = [(900, "http://new.spam.net/"), (901, "http://new.fine.net/"), (902, "http://x.other.org/")]
    pages = frame(good + bad + new, "page_id long, url string")
    outcomes = frame([(i, int(i >= 400)) for i in range(520)] + [(5000, 1), (3, None)],
                     "page_id long, bad int")
    got = {r.page_id: r for r in host_reputation.judge(pages, outcomes, (), Stage(spark)).collect()}
    assert got[0].verdict == "allow" and got[450].verdict == "block"
    assert got[900].verdict == "block" and got[901].verdict == got[902].verdict == "allow"
    assert got[900].n_labelled == 0


def plain_descent(hits, positive, n, prior, how):
    """The corrected risk by loops over texts, its slope by small differences, and Adam's steps."""
    def split(theta):
        """(risk of the positives, estimated risk of the negatives) of a model."""
        z = [sum(theta[f] for f in h) + theta[n] for h in hits]
        pos = [v for v, p in zip(z, positive) if p]
        unl = [v for v, p in zip(z, positive) if not p]
        loss = lambda v: math.log1p(math.exp(-v)) if v > 0 else -v + math.log1p(math.exp(v))
        as_pos = prior * sum(map(loss, pos)) / max(1, len(pos))
        rest = sum(loss(-v) for v in unl) / max(1, len(unl))
        return as_pos, rest - prior * sum(loss(-v) for v in pos) / max(1, len(pos))

    theta = [0.0] * n + [math.log(prior / (1 - prior))]
    first, second = [0.0] * (n + 1), [0.0] * (n + 1)
    turned = 0
    for t in range(1, how.steps + 1):
        rest = split(theta)[1]
        goal = sum if rest >= -how.slack else lambda parts: -parts[1]
        turned += rest < -how.slack
        grad = []
        for k in range(n + 1):
            up, down = [[*theta[:k], theta[k] + d, *theta[k + 1 :]] for d in (1e-5, -1e-5)]
            grad.append((goal(split(up)) - goal(split(down))) / 2e-5 + how.decay * theta[k])
        for k, g in enumerate(grad):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            theta[k] -= how.rate * (first[k] / (1 - 0.9**t)) / (
                math.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return theta, turned


@pytest.mark.parametrize("slack", [0.0, -0.3])
def test_positive_unlabelled_fit_equals_plain_descent(slack):
    rng = np.random.default_rng(8)
    positive = np.arange(40) < 12
    hits = [np.flatnonzero(rng.random(5) < ([0.8, 0.5, 0.3, 0.3, 0.1] if p or i % 4 == 0
                                           else [0.1, 0.2, 0.3, 0.5, 0.6]))
            for i, p in enumerate(positive)]
    how = nnpu.Fit(steps=60, slack=slack)
    weights, bias = nnpu.fit(hits, positive, 5, 0.3, how)
    want, turned = plain_descent([h.tolist() for h in hits], positive.tolist(), 5, 0.3, how)
    assert [*weights, bias] == pytest.approx(want, abs=2e-4)
    assert bool(turned) == (slack < 0)  # the other way is gone, too


def test_positive_unlabelled_scores_equal_plain_sums(spark, edges):
    words = ["one", "rest", "ß", "漢字", "abcd"]
    weights = {f: 0.3 * (i + 1) for i, f in enumerate(
        f for w in words for f in nnpu.word_features(w.encode()))}
    model = nnpu.Model(0.1, -1.0, weights)
    for r in nnpu.scored(edges, model, ["doc_id", "text"]).collect():
        text = (r.row.text or "").encode()
        held = nnpu.feature_set(text)
        want = 1 / (1 + math.exp(1.0 - sum(w for f, w in weights.items() if f in held)))
        assert r.score == pytest.approx(want) and r.predicted == int(want >= 0.7)


def plain_boosting(x, y, how):
    """Score of every row by trees found by trying all cuts, rows in place of tables of bins."""
    def edges_of(column, bins):
        return sorted({float(np.quantile(column, k / bins)) for k in range(1, bins)})

    def bins_of(edges, column):
        return [sum(e <= v for e in edges) for v in column]

    share = (sum(y) + 1) / (len(y) + 2)
    logit = [math.log(share / (1 - share))] * len(y)

    def slopes():
        p = [1 / (1 + math.exp(-v)) for v in logit]
        return [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p]

    def worth(rows, g, h):
        return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + how.ridge)

    def grown(rows, low, high, at, g, h, depth):
        """(rows, step) of the leaves over bins low to high."""
        best = (worth(rows, g, h) + 1e-12, None)
        for cut in range(low + 1, high) if depth else ():
            sides = [i for i in rows if at[i] < cut], [i for i in rows if at[i] >= cut]
            gain = sum(worth(s, g, h) for s in sides)
            if gain > best[0]:
                best = (gain, cut, sides)
        if best[1] is None:
            return [(rows, sum(g[i] for i in rows) / (sum(h[i] for i in rows) + how.ridge))]
        (_, cut, (left, right)) = best
        return grown(left, low, cut, at, g, h, depth - 1) + grown(right, cut, high, at, g, h, depth - 1)

    n, every = len(x[0]), list(range(len(y)))
    columns = [[r[f] for r in x] for f in range(n)]
    fine = [edges_of(c, how.bins) for c in columns]
    at = [bins_of(e, c) for e, c in zip(fine, columns)]
    for _ in range(how.rounds):
        for f in range(n):
            g, h = slopes()
            for rows, step in grown(every, 0, len(fine[f]) + 1, at[f], g, h, 2):
                for i in rows:
                    logit[i] += how.rate * step
    wide = [edges_of(c, how.pair_bins) for c in columns]
    coarse = [bins_of(e, c) for e, c in zip(wide, columns)]

    def quartered(a, b):
        """(gain, leaves) of the best cut of both features."""
        g, h = slopes()
        best = None
        for i in range(1, len(wide[a]) + 1):
            for j in range(1, len(wide[b]) + 1):
                parts = [[r for r in every if (coarse[a][r] < i) == s and (coarse[b][r] < j) == t]
                         for s in (True, False) for t in (True, False)]
                gain = sum(worth(p, g, h) for p in parts)
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, parts)
        leaves = [(p, sum(g[r] for r in p) / (sum(h[r] for r in p) + how.ridge)) for p in best[1]]
        return best[0] - worth(every, g, h), leaves

    gains = sorted((-quartered(a, b)[0], (a, b)) for a in range(n) for b in range(a + 1, n))
    pairs = [p for _, p in gains[: how.pairs]]
    for _ in range(how.rounds):
        for a, b in pairs:
            for rows, step in quartered(a, b)[1]:
                for i in rows:
                    logit[i] += how.rate * step
    return [1 / (1 + math.exp(-v)) for v in logit], pairs


def test_additive_model_equals_plain_boosting():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(90, 3)), 1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.2) | (rng.random(90) < 0.1)).astype(float)
    how = gam.Fit(bins=6, pair_bins=3, pairs=2, rounds=6)
    model = gam.fit(x, y, how)
    want, pairs = plain_boosting(x.tolist(), y.tolist(), how)
    assert model.pairs == pairs and (0, 1) in pairs
    assert gam.score(model, x).tolist() == pytest.approx(want)
