"""Next-hour air-quality class: training and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from airmart import schemas as S
from airmart.functions import class_code

FEATURES = [
    *S.CLASSIFIER_WEATHER, *S.CLASSIFIER_AIR, "PM25_LAG1", "PM25_LAG2", "PM25_ROLL24",
]
TARGET = "NEXT_HOUR_CLASS"


def usable(features: list[str] = FEATURES) -> Column:
    """Rows whose features are all numbers."""
    checks = [F.col(c).isNotNull() & ~F.isnan(c) for c in features]
    return reduce(lambda a, b: a & b, checks)


def fit_classifier(
    training: DataFrame,
    target: str = TARGET,
    on_error: str = "skip",
    features: list[str] = FEATURES,
    trees: int = 20,
    depth: int = 5,
    seed: int = 42,
) -> PipelineModel:
    """Random forest on the training table.

    Features go by name: neither the time nor the label is one. ``skip`` leaves
    out rows with a missing feature or label; ``error`` fails on them. The
    label carries its class names, so all classes keep their place even if a
    training set lacks one.
    """
    if on_error == "skip":
        training = training.where(usable(features) & F.col(target).isNotNull())
    nominal = {"ml_attr": {"type": "nominal", "name": "label", "vals": S.CLASS_NAMES}}
    label = class_code(F.col(target)).cast("double").alias("label", metadata=nominal)
    rows = training.select(*[F.col(c).cast("double").alias(c) for c in features], label)
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed
    )
    # The forest reads its input once per tree level; it caches its own binned form.
    return Pipeline(stages=[assembler, forest]).fit(rows)


def predict(
    model: PipelineModel,
    rows: DataFrame,
    on_error: str = "skip",
    keep: tuple[str, ...] = (S.TIME,),
    features: list[str] = FEATURES,
) -> DataFrame:
    """Predicted class and class probabilities per row.

    Rows with an unusable feature give no prediction: ``skip`` drops them and
    ``keep_rows`` keeps them with NULLs.
    """
    result = predict_object(model, rows, on_error, keep, features)
    value = F.col("PREDICTION_RESULT")
    return result.select(
        *keep,
        value["class"].alias("PREDICTED_CLASS"),
        *[value["probability"][c].alias(f"PROB_{c.upper()}") for c in S.CLASS_NAMES],
    )


def predict_object(
    model: PipelineModel,
    rows: DataFrame,
    on_error: str = "skip",
    keep: tuple[str, ...] = (S.TIME,),
    features: list[str] = FEATURES,
) -> DataFrame:
    """Prediction as one object: ``{class, probability: {Good, Moderate, Poor}}``."""
    if on_error not in ("skip", "keep_rows"):
        raise ValueError(f"unknown on_error {on_error!r}")
    if on_error == "skip":
        rows = rows.where(usable(features))
    known = usable(features)
    # The assembler refuses NULLs; rows marked unknown are blanked again below.
    filled = rows.select(
        *keep,
        known.alias("_known"),
        *[F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)).alias(c) for c in features],
    )
    scored = model.transform(filled)
    probability = vector_to_array("probability")
    names = F.array(*[F.lit(c) for c in S.CLASS_NAMES])
    value = F.struct(
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("class"),
        F.struct(*[probability[i].alias(c) for i, c in enumerate(S.CLASS_NAMES)]).alias(
            "probability"
        ),
    )
    return scored.select(*keep, F.when(F.col("_known"), value).alias("PREDICTION_RESULT"))


class ModelMismatch(RuntimeError):
    """A stored model was trained on other columns or classes than are asked for."""


def describe(
    training: DataFrame, features: list[str] = FEATURES, labels: list[str] = S.CLASS_NAMES, time: str = S.TIME
) -> dict:
    """What a stored model must be used with, and what it has seen."""
    first, last, rows = training.agg(F.min(time), F.max(time), F.count("*")).first()
    return {
        "features": list(features), "labels": list(labels), "first": str(first), "last": str(last), "rows": rows,
    }


def require(facts: dict, **wanted) -> None:
    """Refuse a model whose registered columns or classes differ, also in order."""
    for name, value in wanted.items():
        if facts.get(name) != list(value):
            raise ModelMismatch(f"stored model has {name} {facts.get(name)}, not {list(value)}")


def load_classifier(
    tables, name: str = "classifier_model", features: list[str] = FEATURES, labels: list[str] = S.CLASS_NAMES
) -> PipelineModel:
    """The model of a snapshot or transaction; neither fits anything."""
    require(tables.table(name).facts, features=features, labels=labels)
    return PipelineModel.load(tables.path(name))


def evaluate_by_time(
    training: DataFrame, share: float = 0.8, metric: str = "f1", **fit: int
) -> float:
    """Score on the latest rows of a model fitted on the earlier ones.

    Scores of the training rows themselves say little; this splits by time.
    """
    seconds = F.unix_seconds(F.col(S.TIME).cast("timestamp"))
    limit = training.agg(F.percentile_approx(seconds, share)).scalar()
    model = fit_classifier(training.where(seconds <= limit), **fit)
    scored = predict(model, training.where(seconds > limit), keep=(S.TIME, TARGET))
    pairs = scored.select(
        class_code(F.col("PREDICTED_CLASS")).cast("double").alias("prediction"),
        class_code(F.col(TARGET)).cast("double").alias("label"),
    )
    evaluator = MulticlassClassificationEvaluator(metricName=metric)
    return evaluator.evaluate(pairs)
