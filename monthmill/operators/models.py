"""Training and scoring of market models.

The choice of estimators is ours: logistic regression for the first variant
and the historical fallback, boosted trees for the second.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from monthmill.operators import prep
from monthmill.operators.features import keep_single_carrier
from monthmill.operators.lookups import attach_group_values, with_predictions
from monthmill.operators.routing import FIRST_VARIANT_MARKETS, SECOND_VARIANT_MARKETS
from monthmill.session import durable
from monthmill.sinks.files import model_path, put
from monthmill.sources.tables import record_lines

# Parameters of the boosted variant.
MAX_BIN = 50
MAX_DEPTH = 7

MARKETS_AT_A_TIME = 4


def logistic(label: str, features: str = "features", weight: str | None = None, iterations: int = 50) -> Estimator:
    model = LogisticRegression(featuresCol=features, labelCol=label, maxIter=iterations)
    return model.setWeightCol(weight) if weight else model


def boosted(
    label: str, features: str = "features", classes: int = 2, weight: str | None = None, rounds: int = 20
) -> Estimator:
    """Boosted trees; with more than two classes one model per class."""
    trees = GBTClassifier(
        featuresCol=features, labelCol=label, maxBins=MAX_BIN, maxDepth=MAX_DEPTH, maxIter=rounds, seed=7
    )
    if classes > 2:
        one_per_class = OneVsRest(classifier=trees, featuresCol=features, labelCol=label)
        return one_per_class.setWeightCol(weight) if weight else one_per_class
    return trees.setWeightCol(weight) if weight else trees


def assembled(
    numbers: list[str],
    estimator: Estimator,
    categories: list[str] | None = None,
    scale: bool = False,
    components: int = 0,
) -> Pipeline:
    """A pipeline from plain columns; categories become indicators, unseen ones an indicator of their own.

    ``scale`` moves each feature to mean 0 and deviation 1, ``components`` puts
    so many principal components in their place.
    """
    categories = categories or []
    indexed, shown = [f"{c}_index" for c in categories], [f"{c}_shown" for c in categories]
    stages: list = []
    if categories:
        stages.append(StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep"))
        # Indicators: an index is no number for a linear model, and a small market has fewer rows than categories.
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=shown, dropLast=False, handleInvalid="keep"))
    # The assembler's output passes the wanted stages; the last of them gives ``features``.
    wanted = [StandardScaler(withMean=True)] if scale else []
    wanted += [PCA(k=components)] if components else []
    names = [f"_features_{i}" for i in range(len(wanted))] + ["features"]
    stages.append(VectorAssembler(inputCols=[*numbers, *shown], outputCol=names[0], handleInvalid="error"))
    for stage, before, after in zip(wanted, names, names[1:]):
        stages.append(stage.setInputCol(before).setOutputCol(after))
    return Pipeline(stages=[*stages, estimator])


def train(df: DataFrame, pipeline: Pipeline | Estimator) -> PipelineModel:
    """Fit on the whole input (mode ``full``)."""
    fitted = pipeline if isinstance(pipeline, Pipeline) else Pipeline(stages=[pipeline])
    return fitted.fit(df)


class Switches(NamedTuple):
    """What a training does with its rows and features before the fit."""

    single_carrier: bool = False
    upsampled: bool = False
    balanced: bool = False
    weight: float | None = None
    scale: bool = False
    components: int = 0


def single_carrier_rows(df: DataFrame, label: str, user: str, carrier: str) -> DataFrame:
    """The labelled rows of users of one carrier, stored: they come from a join, and several steps or trainings read them."""
    return durable(keep_single_carrier(df.where(F.col(label).isNotNull()), user, carrier), "single-carrier")


def switched_rows(
    df: DataFrame,
    label: str,
    row_id: str,
    switches: Switches,
    user: str | None = None,
    carrier: str | None = None,
    single: DataFrame | None = None,
) -> DataFrame:
    """The rows a fit sees: users of one carrier, then small classes repeated, then all cut to the smallest, then weights.

    Rows without a label are left out first, so they are no class of their own.
    ``user`` and ``carrier`` name the columns of the first switch; ``single`` are
    its rows if several trainings share them (``single_carrier_rows``).
    """
    rows = df.where(F.col(label).isNotNull())
    if switches.single_carrier:
        if user is None or carrier is None:
            raise ValueError("a training on users of one carrier needs the columns of user and carrier")
        rows = single_carrier_rows(df, label, user, carrier) if single is None else single
    return prep.training_rows(rows, label, row_id, switches.upsampled, switches.balanced, switches.weight)


def train_switched(
    df: DataFrame,
    label: str,
    row_id: str,
    numbers: list[str],
    categories: list[str],
    switches: Switches,
    estimator: Estimator,
    user: str | None = None,
    carrier: str | None = None,
    single: DataFrame | None = None,
) -> PipelineModel:
    """Fit on the rows and features that the switches ask for.

    The rows are stored once, since the fit reads them in every iteration;
    without numbers they are stored as counts, see ``_train_counted``. The
    estimator must take weights if a weight is wanted.
    """
    rows = switched_rows(df, label, row_id, switches, user, carrier, single)
    weight = None if switches.weight is None else "weight"
    if not numbers and _takes_counts(estimator):
        counts = rows.groupBy(*dict.fromkeys([*categories, label, *filter(None, [weight])])).agg(F.count("*").alias("_n"))
        counts = durable(counts.withColumn("_weight", F.col("_n") * (F.col(weight) if weight else 1.0)), "training-counts")
        weighted = estimator.copy().setWeightCol("_weight")
        return _train_counted(counts, assembled([], weighted, categories, switches.scale, switches.components))
    weighted = estimator.copy().setWeightCol(weight) if weight else estimator.copy()
    return train(durable(rows, "training-rows"), assembled(numbers, weighted, categories, switches.scale, switches.components))


def _takes_counts(estimator: Estimator) -> bool:
    """Whether a row of weight n is the same to the fit as n equal rows.

    A penalty is laid on features divided by their deviation, which Spark
    estimates otherwise for weights than for rows.
    """
    return isinstance(estimator, LogisticRegression) and estimator.getRegParam() == 0 and not estimator.isSet("weightCol")


def _train_counted(counts: DataFrame, pipeline: Pipeline) -> PipelineModel:
    """Fit the stages of ``assembled`` on rows that stand for ``_n`` equal rows each.

    Where all features are categories, a training has no more different rows
    than combinations of their values with the labels, however many rows it
    has. The last stage takes the counts as weights. Scaling and components
    take none; they are fitted on rows with the moments of the counted ones.
    """
    df, fitted = counts, []
    for stage in pipeline.getStages():
        if isinstance(stage, Transformer):
            model = stage
        elif isinstance(stage, StandardScaler):
            model = stage.fit(_two_points(df, stage.getInputCol()))
        elif isinstance(stage, PCA):
            model = stage.fit(_mirrored(df, stage.getInputCol()))
        else:
            model = stage.fit(df)
        fitted.append(model)
        if stage is not pipeline.getStages()[-1]:
            df = model.transform(df)
    return PipelineModel(stages=fitted)


def _moments(df: DataFrame, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of each feature over counted rows; exactly 0 deviation where a feature is constant."""
    each = df.select("_n", F.posexplode(vector_to_array(vector)).alias("at", "x"))
    sums = each.groupBy("at").agg(
        F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("x")).alias("s"), F.sum(F.col("_n") * F.col("x") * F.col("x")).alias("ss")
    )
    n, s, ss = np.array([(r.n, r.s, r.ss) for r in sums.orderBy("at").collect()], dtype=float).T
    mean = s / n
    return mean, np.sqrt(np.maximum(ss - s * mean, 0) / np.maximum(n - 1, 1))


def _two_points(df: DataFrame, vector: str) -> DataFrame:
    """Two rows whose mean and sample deviation are those of the counted rows."""
    mean, deviation = _moments(df, vector)
    ends = [(Vectors.dense(mean + sign * deviation / np.sqrt(2)),) for sign in (-1, 1)]
    return df.sparkSession.createDataFrame(ends, [vector])


def _mirrored(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose covariance is that of the counted rows but for a factor, so that their components are the same.

    Each is moved by the mean, stretched by the root of its count and set beside its opposite.
    """
    mean, _ = _moments(df, vector)
    means = F.array(*map(F.lit, mean.tolist()))
    moved = F.zip_with(vector_to_array(vector), means, lambda x, m: (x - m) * F.sqrt("_n"))
    both = df.select(F.explode(F.array(moved, F.transform(moved, lambda x: -x))).alias("x"))
    return both.select(array_to_vector("x").alias(vector))


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Predict (mode ``score``) and keep every input column.

    ``score`` is the probability of the predicted class. One model per class
    gives margins instead; the largest is put on the scale of a probability.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        certainty = F.array_max(vector_to_array("probability"))
    else:
        certainty = 1 / (1 + F.exp(-2 * F.array_max(vector_to_array("rawPrediction"))))
    return out.select(*df.columns, "prediction", certainty.alias("score"))


def score_each(df: DataFrame, models: dict[str, PipelineModel], read: list[str]) -> DataFrame:
    """Every row with a column per model, named as the model: a struct of ``prediction`` and ``score``.

    ``read`` names the columns that the models read, categories only. Each
    combination of their values goes through the models once and is joined to its rows.
    """
    scored = durable(df.select(*read).distinct(), "kinds")
    for name, model in models.items():
        scored = score(scored, model).withColumn(name, F.struct("prediction", "score")).drop("prediction", "score")
    return attach_group_values(df, durable(scored, "scores"), read)


def stored_model(base: str, market: str, model_type: str, month: str) -> PipelineModel:
    return PipelineModel.load(model_path(base, market, model_type, month))


def latest_model(spark: SparkSession, base: str, market: str, model_type: str, before: str) -> PipelineModel:
    """The newest stored model of a month before the given one; a run without any stops."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(model_path(base, market, model_type, "[0-9]" * 6))
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder) or []
    months = sorted(name for name in (f.getPath().getName() for f in found) if name < before)
    if not months:
        raise FileNotFoundError(f"no {model_type} model of {market} before {before} below {base}")
    return stored_model(base, market, model_type, months[-1])


def score_lines(
    spark: SparkSession, lines: str, schema: T.StructType | str, model: PipelineModel, key: str, root: str, name: str
) -> DataFrame:
    """Score records that come as lines of text, store the predictions under root and name, and return every input beside its own.

    The predictions are read back from their files, so what is returned is
    what a later job finds there. ``key`` must be unique; a malformed line stops the job.
    """
    inputs = record_lines(spark, lines, schema)
    predictions = score(inputs, model).select(key, "prediction", "score")
    path = put(predictions, root, name)
    return with_predictions(inputs, spark.read.schema(predictions.schema).parquet(path), key)


def fit_each(spark: SparkSession, names: Iterable[str], fit: Callable[[str], PipelineModel]) -> dict[str, PipelineModel]:
    """Call ``fit`` for each name, several at a time; a small fit leaves most of a cluster idle."""
    names = list(names)
    with ThreadPool(MARKETS_AT_A_TIME) as pool:
        return dict(zip(names, pool.map(inheritable_thread_target(spark)(fit), names)))


def _train_each(df: DataFrame, pipelines: dict[str, Pipeline], market: str) -> dict[str, PipelineModel]:
    return fit_each(df.sparkSession, pipelines, lambda name: train(df.where(F.col(market) == name), pipelines[name].copy()))


def train_markets(df: DataFrame, markets: list[str], pipeline: Pipeline | Estimator, market: str = "market") -> dict[str, PipelineModel]:
    """One model per configured market, each fitted on the rows of its market."""
    return _train_each(df, {name: pipeline for name in markets}, market)


def train_routed(df: DataFrame, label: str, pipelines: dict[str, Pipeline], market: str = "market") -> dict[str, PipelineModel]:
    """One model per market that has training, by the pipeline of the market's variant.

    A market whose rows do not show at least two labels cannot be trained and
    is left out. The check brings one row per configured market to the driver.
    """
    variants = {m: "v1" for m in FIRST_VARIANT_MARKETS} | {m: "v2" for m in SECOND_VARIANT_MARKETS}
    seen = df.where(F.col(market).isin(list(variants))).groupBy(market)
    spans = seen.agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low < high")
    trainable = sorted(row[market] for row in spans.collect())
    return _train_each(df, {name: pipelines[variants[name]] for name in trainable}, market)


def train_types(
    df: DataFrame, pipelines: dict[str, dict[str, Pipeline]], market: str = "market"
) -> dict[str, dict[str, PipelineModel]]:
    """Models by model type and market. ``pipelines`` gives, per type, the pipeline of each variant; a type's label has its name."""
    return {kind: train_routed(df.where(F.col(kind).isNotNull()), kind, routed, market) for kind, routed in pipelines.items()}


def score_types(
    df: DataFrame,
    models: dict[str, dict[str, PipelineModel]],
    fallbacks: dict[str, PipelineModel],
    market: str = "market",
) -> DataFrame:
    """Every row once per model type, with ``model_type``, ``prediction`` and ``score``."""
    parts = [score_markets(df, models[kind], fallbacks[kind], market).withColumn("model_type", F.lit(kind)) for kind in fallbacks]
    return reduce(DataFrame.unionByName, parts)


def score_markets(
    df: DataFrame, models: dict[str, PipelineModel], fallback: PipelineModel | None = None, market: str = "market"
) -> DataFrame:
    """Score each market with its model, and all other rows with the fallback if there is one."""
    parts = [score(df.where(F.col(market) == name), model) for name, model in models.items()]
    if fallback is not None:
        known = F.coalesce(F.col(market).isin(list(models)), F.lit(False))
        parts.append(score(df.where(~known), fallback))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
