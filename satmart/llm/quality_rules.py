"""Rule bitmask ledger: each rule is evaluated once per text and leaves a failure bit beside its
measurements. Policies are versioned masks over the bits, so a new policy, or the effect of
leaving a rule out, needs no second look at the texts."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from satmart.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 8
_SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
_FIELDS = [StructField(name, LongType(), False) for name in MEASURES]


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; ``bit`` never changes once it is published."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """Rejects a text that fails more than ``tolerated`` of the named rules."""

    version: str
    rules: tuple[str, ...]
    tolerated: int = 0

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        return sum(1 << r.bit for r in rules if r.name in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
FULL = Policy("full-1", tuple(r.name for r in RULES))


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that the text holds twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    hashed = np.fromiter(map(hash, words), np.int64, n).astype(np.uint64)
    windows = np.zeros(n - WINDOW + 1, np.uint64)
    for j, odd in enumerate(common.odd_numbers(WINDOW, 1)):
        windows += hashed[j : j + windows.size] * odd
    ordered = np.sort(windows)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    # Some hashes met: number the words, then windows of 2, 4 and 8 words, and compare exactly.
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    for step in (1, 2, 4):
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1].ravel()
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edges) > 0))


def measures_of(raw: bytes) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES."""
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    # Every byte of a character but the first lies inside a word.
    more_bytes = len(raw) - len(raw.decode("utf-8", "replace"))
    return (
        len(words),
        sum(map(len, words)) - more_bytes,
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeat_words(words),
    )


def ledger(
    docs: DataFrame, carry: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``row`` (the carried columns), the measurements and ``fail_bits``, one row per input row.

    A null text counts as the empty one: all measurements are 0 and ``few_words`` fails. Repeated
    rows are judged each on its own. A text is held whole in one task, whatever its length. Columns
    are carried in ``row``, so none can clash; an empty table gives an empty ledger.
    """
    measured = common.over_texts(docs, carry, text, measures_of, _FIELDS)
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)))
    return measured.withColumn("fail_bits", bits.cast("long"))


def rejected(policy: Policy, bits: str = "fail_bits", rules: tuple[Rule, ...] = RULES) -> Column:
    return F.bit_count(F.col(bits).bitwiseAND(F.lit(policy.mask(rules)))) > policy.tolerated


def ablations(book: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule of a policy does: texts failing it, failing it alone, and kept without it.

    The ledger is first counted by its masked bits, map-side, so at most 2^rules rows are left.
    """
    counted = book.groupBy(
        F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules))).alias("bits")
    ).agg(F.count("*").alias("n"))
    named = [r for r in rules if r.name in policy.rules]
    per_rule = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                  for r in named])
    ).alias("r")
    bits, bit = F.col("bits"), F.col("r.bit")
    left = F.bit_count(bits.bitwiseAND(F.bitwise_not(bit)))
    fails = bits.bitwiseAND(bit) != 0
    return (
        counted.select("bits", "n", per_rule)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(bits == bit, F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(left <= policy.tolerated, F.col("n")).otherwise(0)).alias("n_kept_without"),
            F.sum(F.when(F.bit_count(bits) <= policy.tolerated, F.col("n")).otherwise(0))
            .alias("n_kept"),
        )
        .withColumn("policy", F.lit(policy.version))
    )


def keep_good(docs: DataFrame, policy: Policy = FULL, text: str = "text") -> DataFrame:
    """The rows whose text the policy does not reject, with their own columns."""
    book = ledger(docs, docs.columns, text)
    return book.filter(~rejected(BASE) & ~rejected(policy)).select("row.*")
