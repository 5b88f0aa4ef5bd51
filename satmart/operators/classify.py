"""Saturation classifier: training set, folds, forest, out-of-fold scores and classification."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.functions.levels import DOMAINS, level
from satmart.functions.numbers import half_even
from satmart.operators.panel import LAG_COLUMNS, complete
from satmart.operators.scale import position_by_digest
from satmart.settings import Settings

FEATURES = [*LAG_COLUMNS, "mes"]


def training_set(features: DataFrame, s: Settings) -> DataFrame:
    """Complete department-months of the training years with their level."""
    rows = complete(features.where(F.col("anio").isin(*s.train_years)))
    return rows.withColumn("nivel", level(F.col("ratio"), s.scheme, s))


def class_weights(train: DataFrame) -> DataFrame:
    """(nivel, n, weight): rows / (classes x rows of the class)."""
    counts = train.groupBy("nivel").agg(F.count("*").alias("n"))
    every_class = W.partitionBy()  # a handful of rows: one per level of the scheme
    total, classes = F.sum("n").over(every_class), F.count("*").over(every_class)
    return counts.withColumn("weight", total / (classes * F.col("n")))


def fold_count(train: DataFrame, s: Settings) -> Column:
    """As many folds as the smallest class has rows, from two to the limit."""
    smallest = train.groupBy("nivel").agg(F.count("*").alias("n")).agg(F.min("n")).scalar()
    return F.greatest(F.lit(2), F.least(F.lit(s.max_folds), smallest))


def stratified_folds(train: DataFrame, entity: str, s: Settings) -> DataFrame:
    """Adds ``fold``: rows of a class, shuffled by a seeded digest, are dealt round the folds."""
    text = F.concat_ws("|", F.lit(str(s.seed)), F.col(entity), F.date_format("ds", "yyyy-MM-dd"))
    placed = position_by_digest(train, "nivel", F.md5(text))
    fold = (F.col("position") - 1) % fold_count(train, s)
    return placed.withColumn("fold", fold.cast("int")).drop("position")


def _label(s: Settings) -> Column:
    names = F.array(*map(F.lit, DOMAINS[s.scheme]))
    return (F.array_position(names, F.col("nivel")) - 1).cast("double")


def encoder(rows: DataFrame, entity: str) -> PipelineModel:
    """Lags, month and one-hot entity as one vector; the month's own ratio stays out, since it
    defines the level. Entities here are departments, at most a hundred two-digit codes."""
    stages = [
        StringIndexer(inputCol=entity, outputCol="_entity", handleInvalid="keep"),
        OneHotEncoder(inputCol="_entity", outputCol="_one_hot", dropLast=False),
        VectorAssembler(inputCols=[*FEATURES, "_one_hot"], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(rows)


def assembled(train: DataFrame, encode: PipelineModel, s: Settings) -> DataFrame:
    """Training rows with feature vector, label and balanced class weight.

    The weights side has one row per class.
    """
    weights = F.broadcast(class_weights(train).select("nivel", "weight"))
    return encode.transform(train.join(weights, "nivel").withColumn("label", _label(s)))


def fit_forest(train: DataFrame, encode: PipelineModel, s: Settings):
    """Forest on balanced class weights.

    Each level of the trees is a job over all rows, so these are dealt into as few partitions as
    their size asks for, which adaptive execution decides: a small table is one task a job."""
    rows = assembled(train, encode, s).hint("rebalance")
    forest = RandomForestClassifier(
        numTrees=s.trees, maxDepth=s.max_depth, seed=s.seed, weightCol="weight",
        minInstancesPerNode=1, maxMemoryInMB=1024,
    )
    return forest.fit(rows.select("features", "label", "weight"))


def predict_level(model, encode: PipelineModel, rows: DataFrame, s: Settings) -> DataFrame:
    names = F.array(*map(F.lit, DOMAINS[s.scheme]))
    scored = model.transform(encode.transform(rows))
    return scored.select(
        *rows.columns,
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted"),
    )


def folds_of(folded: DataFrame) -> list[int]:
    """The folds, at most ``max_folds``."""
    return [r.fold for r in folded.select("fold").distinct().orderBy("fold").collect()]


def fit_forests(
    folded: DataFrame, encode: PipelineModel, s: Settings, whole: bool = True
) -> dict:
    """One forest per fold, fitted without that fold, and with ``whole`` under None the forest
    on all rows.

    There are at most ``max_folds`` + 1 fits. They run side by side, so a small training set
    does not leave the cluster idle. Each reads ``folded`` anew: hand in a written table.
    """
    def fit(left_out: int | None):
        kept = folded if left_out is None else folded.where(F.col("fold") != left_out)
        return fit_forest(kept, encode, s)

    parts = [*[None] * whole, *folds_of(folded)]
    with ThreadPool(len(parts)) as pool:
        models = pool.map(inheritable_thread_target(folded.sparkSession)(fit), parts)
    return dict(zip(parts, models))


def out_of_fold(
    folded: DataFrame, predictors: dict[int | None, Callable[[DataFrame], DataFrame]]
) -> DataFrame:
    """Every training row with the level predicted by the predictor that did not see its fold.

    A predictor adds ``predicted`` to rows; the one under None, fitted on all rows, is not used.
    """
    result = None
    for fold, predict in predictors.items():
        if fold is None:
            continue
        part = predict(folded.where(F.col("fold") == fold))
        result = part if result is None else result.unionByName(part)
    return result


def forest_predictors(forests: dict, encode: PipelineModel, s: Settings) -> dict:
    return {f: partial(predict_level, m, encode, s=s) for f, m in forests.items()}


def majority_predictors(folded: DataFrame) -> dict:
    """The plainest rival: per fold, the level that most rows of the other folds have.

    Ties go to the first name. One row per fold and level comes to the driver.
    """
    counts = folded.groupBy("fold", "nivel").agg(F.count("*").alias("n")).collect()
    predictors = {}
    for fold in sorted({r.fold for r in counts}):
        seen: dict[str, int] = {}
        for r in counts:
            if r.fold != fold:
                seen[r.nivel] = seen.get(r.nivel, 0) + r.n
        level_ = min(seen, key=lambda name: (-seen[name], name)) if seen else None
        predictors[fold] = partial(_always, level_)
    return predictors


def _always(name: str | None, rows: DataFrame) -> DataFrame:
    return rows.withColumn("predicted", F.lit(name).cast("string"))


def class_report(scored: DataFrame, actual: str = "nivel", predicted: str = "predicted"):
    """(nivel, precision, recall, f1, support) per class; 0 where a score is undefined.

    Counts per (actual, predicted) pair come first: a few rows, whatever the table's size.
    """
    pairs = scored.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(
        F.count("*").alias("n")
    )
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("a").alias("nivel"),
                    F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hit"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                ),
                F.struct(
                    F.col("p").alias("nivel"),
                    F.lit(0).cast("bigint").alias("hit"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("predicted"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    totals = sides.groupBy("nivel").agg(
        F.sum("hit").cast("double").alias("hit"),
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
    )

    def share(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return totals.select(
        "nivel",
        share(F.col("hit"), F.col("predicted")).alias("precision"),
        share(F.col("hit"), F.col("support")).alias("recall"),
        share(2 * F.col("hit"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
    )


def report_averages(report: DataFrame) -> DataFrame:
    """The report's closing rows: accuracy, and plain and support-weighted averages."""
    n = F.sum("support")

    def weighted(c: str) -> Column:
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), n), F.lit(0.0))

    scores = ("precision", "recall", "f1")
    wide = report.agg(
        n.alias("support"),
        *[F.avg(c).alias(f"avg_{c}") for c in scores],
        *[weighted(c).alias(f"w_{c}") for c in scores],
    )
    # Accuracy is the support-weighted recall.
    rows = [
        F.struct(
            F.lit(name).alias("nivel"),
            *[F.col(f"{prefix}_{c}").alias(c) for c in scores],
            F.col("support"),
        )
        for name, prefix in (("macro avg", "avg"), ("weighted avg", "w"))
    ]
    accuracy = F.struct(
        F.lit("accuracy").alias("nivel"),
        *[F.col("w_recall").alias(c) for c in scores],
        F.col("support"),
    )
    return wide.select(F.explode(F.array(accuracy, *rows)).alias("r")).select("r.*")


def f1_scores(report: DataFrame) -> DataFrame:
    """One row: F1 averaged over classes, plain and weighted by support, in percent."""
    weighted = F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support"))
    return report.agg(
        (F.avg("f1") * 100).alias("f1_macro"), (weighted * 100).alias("f1_weighted")
    )


def acceptance(report: DataFrame, limit: float) -> DataFrame:
    """F1 scores and whether the plain average reaches the limit."""
    return f1_scores(report).withColumn("passes", F.col("f1_macro") >= limit)


def persistence(train: DataFrame, s: Settings) -> DataFrame:
    """The plain rival of the forest: next month keeps last month's level."""
    return train.withColumn("predicted", level(F.col("ratio_lag1"), s.scheme, s))


def classified(scored: DataFrame, f1_macro: Column, entity: str) -> DataFrame:
    """Projected months with ratio, predicted level and the classifier's score."""
    return scored.select(
        entity,
        F.col("ds").alias("mes_clasificado"),
        half_even(F.col("ratio"), 2).alias("ratio_saturacion"),
        F.col("predicted").alias("nivel_saturacion"),
        half_even(f1_macro, 2).alias("f1_score_validacion"),
    )
