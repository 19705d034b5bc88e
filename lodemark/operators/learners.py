"""Spark ML learners behind the four algorithm names, early stopping, random search, scoring and explanation."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodemark.functions.columns import best_class, col
from lodemark.operators.boosting import FEATURES, LABEL, VALIDATES, WEIGHT, Booster, BoosterSpec, probabilities
from lodemark.operators.encode import Contract
from lodemark.operators.explain import (Leaves, causes_of_array, centred_contributions, feature_means, read_trees,
                                        tree_contributions)
from lodemark.operators.metrics import confusion_metrics, macro_metrics, ranking_metrics, regression_metrics
from lodemark.operators.targets import balanced_weights
from lodemark.settings import BINARY, BOOSTED, MULTICLASS, REGRESSION, UseCase
from lodemark.sources.scans import staged

# The search space of each algorithm.
SEARCH_SPACE = {
    "xgboost": {
        "max_depth": [2, 3, 4, 5],
        "min_child_weight": [10, 25, 50, 100, 200],
        "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
        "colsample_bytree": [0.5, 0.6, 0.7, 0.8, 1.0],
        "learning_rate": [0.02, 0.03, 0.05, 0.08, 0.10],
        "reg_lambda": [1.0, 3.0, 10.0, 30.0],
        "reg_alpha": [0.0, 0.1, 1.0],
        "use_scale_pos_weight": True,
    },
    "lightgbm": {
        "num_leaves": [15, 31, 63, 127],
        "min_child_samples": [10, 25, 50, 100],
        "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
        "colsample_bytree": [0.5, 0.6, 0.7, 0.8, 1.0],
        "learning_rate": [0.02, 0.03, 0.05, 0.08, 0.10],
        "reg_lambda": [0.0, 1.0, 3.0, 10.0],
        "reg_alpha": [0.0, 0.1, 1.0],
        "use_scale_pos_weight": True,
    },
    "random_forest": {
        "n_estimators": [200, 400, 600, 800],
        "max_depth": [4, 6, 8, 10],
        "min_samples_leaf": [5, 10, 25, 50],
        "max_features": ["sqrt", "log2", 0.5],
    },
    "logistic_regression": {
        "C": [0.01, 0.03, 0.1, 0.3, 1.0, 3.0],
        "penalty": ["l2"],
    },
}

# Parameters that are not searched. The boosting rounds are a maximum: a search stops by patience.
FIXED_PARAMS = {
    "xgboost": {"n_estimators": 2000},
    "lightgbm": {"n_estimators": 2000},
    "random_forest": {},
    "logistic_regression": {"max_iter": 2000, "class_weight": "balanced"},
}

MIN_FINAL_ROUNDS = 50


def build_estimator(algorithm: str, params: dict, seed: int, task: str, rows: int):
    """A Spark estimator, or the settings of a booster, for the algorithm name and its usual parameter names. `rows` turns the
    inverse penalty C into Spark's per-row penalty."""
    p = dict(params)
    columns = {"featuresCol": FEATURES, "labelCol": LABEL}
    if algorithm in BOOSTED:
        return BoosterSpec.of(algorithm, p, seed, task)
    if algorithm == "random_forest":
        settings = dict(numTrees=int(p.get("n_estimators", 100)), maxDepth=int(p.get("max_depth", 5)), seed=seed,
                        minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                        featureSubsetStrategy=_subset(p.get("max_features", "sqrt")), **columns)
        return RandomForestRegressor(**settings) if task == REGRESSION else RandomForestClassifier(**settings)
    if algorithm == "logistic_regression":
        if task == REGRESSION:
            return LinearRegression(standardization=False, **columns)
        return LogisticRegression(regParam=1.0 / (float(p.get("C", 1.0)) * max(rows, 1)), elasticNetParam=0.0,
                                  maxIter=int(p.get("max_iter", 100)), standardization=False, **columns)
    raise ValueError(f"unsupported algorithm {algorithm!r}")


def _subset(share) -> str:
    if isinstance(share, str):
        return share
    return "all" if share >= 1.0 else str(float(share))


def weighted(df: DataFrame, target: str, params: dict, task: str) -> tuple[DataFrame, bool]:
    """Adds the row weight a parameter set asks for: a positive-class weight, or balanced classes."""
    if task == BINARY and params.get("scale_pos_weight", 1.0) != 1.0:
        return df.withColumn(WEIGHT, F.when(col(target) == 1, float(params["scale_pos_weight"])).otherwise(1.0)), True
    if task != REGRESSION and params.get("class_weight") == "balanced":
        weight = F.lit(1.0)
        for value, w in balanced_weights(df, target).items():
            weight = F.when(col(target) == value, w).otherwise(weight)
        return df.withColumn(WEIGHT, weight), True
    return df, False


def assembler(contract: Contract) -> VectorAssembler:
    return VectorAssembler(inputCols=contract.encoded, outputCol=FEATURES, handleInvalid="keep")


def fit(df: DataFrame, target: str, contract: Contract, algorithm: str, params: dict, seed: int, task: str,
        rows: int, validates: Column | None = None, patience: int = 50) -> PipelineModel:
    """Fits on encoded rows. With `validates` (rows kept for validation) a booster stops by patience on them."""
    data, has_weight = weighted(df, target, params, task)
    estimator = build_estimator(algorithm, params, seed, task, rows)
    stage = assembler(contract)
    data = data.withColumn(VALIDATES, F.lit(False) if validates is None else validates)
    data = stage.transform(data.withColumn(LABEL, col(target).cast("double")))
    data = data.select(*[c for c in (FEATURES, LABEL, WEIGHT, VALIDATES) if c in data.columns])
    if algorithm in BOOSTED:
        return PipelineModel([stage, *_boosted(data, estimator, task, None if validates is None else patience)])
    if has_weight:
        estimator = estimator.setWeightCol(WEIGHT)
    return PipelineModel([stage, estimator.fit(data.where(~F.col(VALIDATES)).drop(VALIDATES))])


def _boosted(data: DataFrame, spec: BoosterSpec, task: str, patience: int | None, start: Sequence[GBTRegressionModel] = ()) -> list[GBTRegressionModel]:
    classes = len(start) or (int(data.agg(F.max(LABEL)).first()[0] or 0) + 1 if task == MULTICLASS else 1)
    booster = Booster(data, task, classes, spec, start)
    if patience is None:
        booster.grow(spec.rounds - booster.rounds)
        return booster.models()
    return booster.models(booster.grow_with_patience(patience))


def more_rounds(model: PipelineModel, df: DataFrame, target: str, algorithm: str, params: dict, seed: int, task: str) -> PipelineModel:
    """A fitted booster grown on to params' `n_estimators` rounds over encoded rows; what it has is not fitted again."""
    stage, *ensembles = model.stages
    data, _ = weighted(df, target, params, task)
    data = stage.transform(data.withColumn(LABEL, col(target).cast("double")))
    data = data.select(*[c for c in (FEATURES, LABEL, WEIGHT) if c in data.columns])
    return PipelineModel([stage, *_boosted(data, build_estimator(algorithm, params, seed, task, 0), task, None, ensembles)])


def is_booster(model: PipelineModel) -> bool:
    return isinstance(model.stages[-1], GBTRegressionModel)


def rounds_used(model: PipelineModel) -> int | None:
    """Rounds of a booster, whose first tree is a constant."""
    return int(model.stages[-1].getNumTrees) - 1 if is_booster(model) else None


# ------------------------------------------------------------------------------------------------------ scoring

def score(model: PipelineModel, df: DataFrame, task: str) -> DataFrame:
    """Adds SCORE (probability of class 1, confidence, or value) and YHAT (class code or value).

    A binary YHAT is the learner's own 0.5 cut; the caller applies its threshold to SCORE.
    """
    out = model.transform(df)
    if task == REGRESSION:
        added = {"SCORE": F.col("prediction"), "YHAT": F.col("prediction")}
    elif task == BINARY and is_booster(model):
        added = {"SCORE": 1 / (1 + F.exp(-F.col("prediction"))), "YHAT": (F.col("prediction") > 0).cast("int")}
    elif task == BINARY:
        added = {"SCORE": vector_to_array("probability")[1], "YHAT": F.col("prediction").cast("int")}
    else:
        p, classes = class_probabilities(model)
        confidence, label = best_class(p, [str(k) for k in range(classes)])
        added = {"SCORE": confidence, "YHAT": label.cast("int")}
    margins = [m.getPredictionCol() for m in model.stages[1:]]
    return out.withColumns(added).drop(FEATURES, "rawPrediction", "probability", "prediction", *margins)


def class_probabilities(model: PipelineModel) -> tuple[Column, int]:
    """Array of class probabilities and the number of classes. A booster has one ensemble of margins per class."""
    if is_booster(model):
        margins = [F.col(m.getPredictionCol()) for m in model.stages[1:]]
        return probabilities(F.array(*margins), MULTICLASS), len(margins)
    return vector_to_array("probability"), model.stages[-1].numClasses


# -------------------------------------------------------------------------------------------------- explanation

def causes(model: PipelineModel, scored: DataFrame, contract: Contract, means: dict[str, float], task: str, top: int) -> DataFrame:
    """The scored rows with PROBABLE_CAUSES, for the predicted class when there are several."""
    explained, sources = contributions(model, scored, contract, means, task)
    return explained.withColumn("PROBABLE_CAUSES", causes_of_array(F.col("PHI"), sources, top)).drop("PHI")


def leaves(model: PipelineModel, task: str) -> Leaves:
    """Leaf table of a fitted tree ensemble; several classes have one ensemble each in a booster, class shares in a forest."""
    if is_booster(model):
        boosters = model.stages[1:] if task == MULTICLASS else model.stages[-1:]
        return read_trees(boosters, [m.treeWeights for m in boosters])
    forest = model.stages[-1]
    return read_trees([forest], [[w / forest.getNumTrees for w in forest.treeWeights]], classes=task != REGRESSION)


def contributions(model: PipelineModel, scored: DataFrame, contract: Contract, means: dict[str, float], task: str) -> tuple[DataFrame, list[str]]:
    """(rows scored by `score` with PHI, an array of contributions per source feature, and the source names)."""
    learner, encoded = model.stages[-1], contract.encoded
    if hasattr(learner, "treeWeights"):
        return tree_contributions(scored, leaves(model, task), contract, "YHAT" if task == MULTICLASS else None)
    if task == MULTICLASS:
        rows = learner.coefficientMatrix.toArray()
        sources = list(dict.fromkeys(f.source for f in contract.features))
        per_class = [centred_contributions(dict(zip(encoded, r)), means, contract.sources) for r in rows]
        table = F.array(*[F.array(*[c[s] for s in sources]) for c in per_class])
        return scored.withColumn("PHI", F.get(table, F.col("YHAT"))), sources
    by_source = centred_contributions(dict(zip(encoded, learner.coefficients.toArray())), means, contract.sources)
    return scored.withColumn("PHI", F.array(*by_source.values())), list(by_source)


def importance_contributions(model: PipelineModel, contract: Contract, means: dict[str, float]) -> dict[str, Column]:
    """The rough fallback for any model with importances: importance · (x − mean)."""
    learner = model.stages[-1]
    values = learner.featureImportances.toArray() if hasattr(learner, "featureImportances") else learner.coefficients.toArray()
    return centred_contributions(dict(zip(contract.encoded, values)), means, contract.sources)


# ------------------------------------------------------------------------------------------------------- search

@dataclass(frozen=True)
class SearchResult:
    params: dict
    rounds: int | None
    trials: DataFrame   # one row per trial, best first
    best_score: float


def trial_params(space: dict, n: int, seed: int, task: str, ratio: float) -> list[dict]:
    """`n` seeded random draws from the space; a binary task may also draw the positive-class weight."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(n):
        p = {k: rng.choice(values) for k, values in space.items() if k != "use_scale_pos_weight"}
        if task == BINARY and space.get("use_scale_pos_weight"):
            p["scale_pos_weight"] = rng.choice([1.0, math.sqrt(ratio), ratio])
        drawn.append(p)
    return drawn


def search(train: DataFrame, validates: Column, target: str, contract: Contract, use_case: UseCase) -> SearchResult:
    """Random search on the fit rows, judged on the validation rows. Error metrics are negated: more is better.

    `train` should be persisted by the caller; each trial is a set of Spark jobs over it, `parallelism` at a time.
    """
    task, spec = use_case.task, use_case.model
    space = spec.search_space or SEARCH_SPACE[spec.algorithm]
    fixed = {**FIXED_PARAMS[spec.algorithm], **spec.fixed_params}
    fit_rows = train.where(~validates)
    held = train.where(validates)
    stats = fit_rows.agg(F.count("*").alias("n"), F.count_if(col(target) == 0).alias("neg"),
                         F.count_if(col(target) == 1).alias("pos")).first()
    ratio = stats["neg"] / max(stats["pos"], 1) if task == BINARY else 1.0
    draws = trial_params(space, spec.trials, use_case.split.seed, task, ratio)

    @inheritable_thread_target(train.sparkSession)
    def run(p: dict) -> tuple[float, int | None]:
        model = fit(train, target, contract, spec.algorithm, {**fixed, **p}, use_case.split.seed, task, stats["n"], validates,
                    spec.early_stopping_rounds)
        return validation_score(staged(score(model, held, task)), target, task, use_case.metric), rounds_used(model)

    with ThreadPool(max(spec.parallelism, 1)) as pool:
        results = pool.map(run, draws)
    order = sorted(range(len(draws)), key=lambda i: -results[i][0])
    best = order[0]
    rounds = fixed.get("n_estimators")
    if results[best][1]:
        rounds = max(int(results[best][1] * 1.1), MIN_FINAL_ROUNDS)
    trials = _trials_frame(train.sparkSession, [(i + 1, draws[i], results[i]) for i in order])
    return SearchResult(draws[best], rounds, trials, results[best][0])


def validation_score(scored: DataFrame, target: str, task: str, metric: str) -> float:
    if task == REGRESSION:
        value = regression_metrics(scored, target, "YHAT").first()[metric]
        return float("-inf") if value is None else (value if metric == "r2" else -value)
    if task == MULTICLASS:
        return macro_metrics(scored, target, "YHAT").first()["f1_macro"]
    if metric == "f1":
        flagged = scored.withColumn("YHAT", (F.col("SCORE") >= 0.5).cast("int"))
        return confusion_metrics(flagged, target, "YHAT").first()["f1"]
    value = ranking_metrics(scored, target, "SCORE").first()[metric]
    return float("-inf") if value is None else value


def _trials_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    import json
    data = [(n, json.dumps(p, sort_keys=True), rounds, float(value)) for n, p, (value, rounds) in rows]
    return spark.createDataFrame(data, "TRIAL int, PARAMS_JSON string, BEST_ITERATION int, VAL_SCORE double").orderBy(
        F.desc("VAL_SCORE"), "TRIAL")


def fit_final(train: DataFrame, target: str, contract: Contract, use_case: UseCase, params: dict, rounds: int | None,
              algorithm: str | None = None) -> PipelineModel:
    """The model on all training rows with the chosen parameters and, for boosters, the chosen number of rounds."""
    algorithm = algorithm or use_case.model.algorithm
    fixed = {**FIXED_PARAMS[algorithm], **(use_case.model.fixed_params if algorithm == use_case.model.algorithm else {})}
    if algorithm in BOOSTED and rounds:
        fixed["n_estimators"] = rounds
    return fit(train, target, contract, algorithm, {**fixed, **params}, use_case.split.seed, use_case.task, train.count())


def training_means(train: DataFrame, contract: Contract) -> dict[str, float]:
    return feature_means(train, contract.encoded)
