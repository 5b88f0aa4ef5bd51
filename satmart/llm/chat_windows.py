"""Budgeted windows over conversations: prefix sums of turn tokens cut a conversation into spans of
whole turns; every span keeps the system turn, repeats a limited history, and counts loss only on
assistant texts that appear for the first time. DataFrame functions only.

A turn is written as ``<s>role\\ntext</s>``. Inside roles and texts a backslash is doubled and a
backslash is put behind the first character of each control string, so no text can end a turn, and
the original comes back exactly."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Template marks, and the marks of a widespread other template; none may occur inside a text.
_CONTROL = r"(<)(/?s>)|(\[)(/?INST\])"
_OPEN, _CLOSE, _ROLE_LINE = "<s>", "</s>", "[/INST]"
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, of the history it repeats, of a turn that shares a window, per mark."""

    window: int = 512
    history: int = 96
    turn: int = 160
    marks: int = 4


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1$3\\$2$4")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def windows(turns: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """conv_id, span, formatted, loss, n_repeated, n_fresh, n_tokens and over_budget.

    ``loss`` lists start and length, in characters, of each text under the loss mask. Turns run by
    turn, role and text; repeated rows stay. Null roles and texts count as empty; a null conv_id is
    a conversation of its own. A system turn counts as such only in first place. A turn longer
    than ``budget.turn`` gets a span to itself and is never cut: only where it does not fit with
    the system turn is ``over_budget`` true. Extra columns are not read.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy("conv_id")
    tokens, system = F.col("tokens"), F.col("is_system")
    clean = turns.select(
        "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    role_mark = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(_ROLE_LINE))
    numbered = (
        clean.withColumns({
            "tokens": F.regexp_count("text", F.lit(WORD)) + budget.marks,
            "lead": F.concat(F.lit(_OPEN), role_mark, F.lit("\n")),
            "inner": escaped(F.col("text")),
        })
        .withColumn("seq", F.row_number().over(order))
        .withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        .withColumn("is_system", (F.col("seq") == 1) & (F.col("role") == "system"))
        .withColumn("body", F.concat("lead", "inner", F.lit(_CLOSE)))
        .withColumn("system", F.max(F.when(system, F.struct("tokens", "body"))).over(whole))
        .withColumn("system_tokens", F.coalesce("system.tokens", F.lit(0)))
        .withColumn("is_long", tokens > budget.turn)
        .withColumn("long_no", F.sum(F.col("is_long").cast("int")).over(order))
    )
    # A span takes the turns that start in one cell of the stride; what its last turn runs over
    # the cell is at most budget.turn, so system, history and fresh turns fit the window.
    stride = F.greatest(
        F.lit(1), F.lit(budget.window - budget.history - budget.turn) - F.col("system_tokens"))
    run = W.partitionBy("conv_id", "long_no", "is_long")
    cell = F.floor((F.col("start") - F.min("start").over(run)) / stride)
    key = F.struct("long_no", "is_long", "cell")
    past = W.partitionBy("conv_id").orderBy("start").rangeBetween(-budget.history, -1)
    in_span = W.partitionBy("conv_id", "span").orderBy("seq")
    spanned = (
        numbered.withColumn("cell", cell)
        .withColumn("opens", F.coalesce(key != F.lag(key).over(order), F.lit(True)))
        .withColumn("span", F.sum(F.col("opens").cast("int")).over(order))
        .withColumn("history", F.collect_list(
            F.when(~system, F.struct("start", "seq", "body"))).over(past))
        .withColumn("offset", F.coalesce(
            F.sum(F.length("body")).over(in_span.rowsBetween(W.unboundedPreceding, -1)),
            F.lit(0)))
    )
    # What history may cost: its own limit, and for a long turn what the window leaves.
    room = F.least(F.lit(budget.history), F.lit(budget.window) - F.col("system_tokens")
                   - F.when(F.col("is_long"), tokens).otherwise(0))
    kept = F.filter("history", lambda h: F.col("start") - h["start"] <= room)
    opening = F.struct(
        F.col("start").alias("start"),
        F.when(F.col("seq") > 1, F.col("system")).alias("system"),
        F.sort_array(kept).alias("history"),
    )
    counts = (F.col("role") == "assistant").alias("counts")
    spans = spanned.groupBy("conv_id", "span").agg(
        F.first(F.when(F.col("opens"), opening), ignorenulls=True).alias("opening"),
        F.sort_array(F.collect_list(F.struct(
            "seq", "body", counts,
            (F.col("offset") + F.length("lead")).alias("at"),
            F.length("inner").alias("length"),
        ))).alias("fresh"),
        F.sum("tokens").alias("fresh_tokens"),
    )
    system_body = F.coalesce("opening.system.body", F.lit(""))
    past_body = F.array_join(F.transform("opening.history", lambda h: h["body"]), "")
    past_tokens = F.coalesce(
        F.col("opening.start") - F.get("opening.history.start", F.lit(0)), F.lit(0))
    n_tokens = (F.col("fresh_tokens") + past_tokens
                + F.coalesce("opening.system.tokens", F.lit(0)))
    lead = F.length(F.col("repeated"))
    return (
        spans.withColumn("repeated", F.concat(system_body, past_body))
        .select(
            "conv_id", "span",
            F.concat("repeated", F.array_join(F.transform("fresh", lambda t: t["body"]), ""))
            .alias("formatted"),
            F.transform(
                F.filter("fresh", lambda t: t["counts"]),
                lambda t: F.struct((lead + t["at"]).alias("start"), t["length"].alias("length")),
            ).alias("loss"),
            (F.size("opening.history") + F.col("opening.system").isNotNull().cast("int"))
            .alias("n_repeated"),
            F.size("fresh").alias("n_fresh"),
            n_tokens.alias("n_tokens"),
            (n_tokens > budget.window).alias("over_budget"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, from nothing but the output of ``windows``.

    One conversation's text meets in one task here, as a digest over it in order demands.
    """
    turns = F.slice(F.split("formatted", _CLOSE), F.col("n_repeated") + 1, F.col("n_fresh"))

    def original(turn: Column) -> Column:
        lead = F.substring_index(turn, "\n", 1)
        role = F.replace(F.substr(lead, F.lit(len(_OPEN) + 1)), F.lit(_ROLE_LINE), F.lit("\n"))
        text = F.substr(turn, F.length(lead) + 2)
        return F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))

    def under_mask(span: Column) -> Column:
        return unescaped(F.substr("formatted", span["start"] + 1, span["length"]))

    parts = formatted.select(
        "conv_id", "span", "n_fresh", "formatted",
        F.array_join(F.transform(turns, original), "").alias("turns"),
        F.array_join(F.transform("loss", under_mask), "").alias("loss_text"),
    )
    joined = parts.groupBy("conv_id").agg(
        F.sum("n_fresh").cast("long").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("span", "turns", "loss_text"))).alias("spans"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
    )
    loss_text = F.array_join("spans.loss_text", "")
    return joined.select(
        "conv_id", "n_turns",
        F.sha2(F.array_join("spans.turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss_text).cast("long").alias("loss_chars"),
        F.sha2(loss_text.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "n_windows",
    )
