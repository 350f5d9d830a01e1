"""Spark ML models with their feature stages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators.ordered import row_index
from tidalframe.session import cut_lineage


@dataclass(frozen=True)
class Design:
    """Target and predictors of a model.

    ``nominal`` columns get a slot for each level, which the driver lists; ``hashed`` ones,
    such as ids, share ``slots`` slots by a hash, however many values they have.
    """

    target: str
    numeric: tuple[str, ...] = ()
    nominal: tuple[str, ...] = ()
    scaled: bool = False
    one_hot: bool = True
    hashed: tuple[str, ...] = ()
    slots: int = 1024


def stages(design: Design) -> list:
    """Alphabetical level codes, sparse 0/1 vectors, one feature vector."""
    out: list = []
    inputs = list(design.numeric)
    if design.nominal:
        codes = [f"{c}_code" for c in design.nominal]
        out.append(
            StringIndexer(
                inputCols=list(design.nominal),
                outputCols=codes,
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
        if design.one_hot:
            flags = [f"{c}_flags" for c in design.nominal]
            out.append(OneHotEncoder(inputCols=codes, outputCols=flags, dropLast=True))
            inputs += flags
        else:
            inputs += codes
    if design.hashed:
        hasher = FeatureHasher(inputCols=list(design.hashed), outputCol="hashed_flags", numFeatures=design.slots)
        out.append(hasher.setCategoricalCols(list(design.hashed)))
        inputs.append("hashed_flags")
    raw = "raw_features" if design.scaled else "features"
    out.append(VectorAssembler(inputCols=inputs, outputCol=raw, handleInvalid="keep"))
    if design.scaled:
        out.append(StandardScaler(inputCol=raw, outputCol="features", withMean=True, withStd=True))
    return out


def aimed(design: Design, model: Estimator) -> Estimator:
    """A copy of the learner that predicts the design's target."""
    model = model.copy()
    if model.hasParam("labelCol"):
        model.set(model.getParam("labelCol"), design.target)
    return model


def workflow(design: Design, model: Estimator) -> Pipeline:
    return Pipeline(stages=[*stages(design), aimed(design, model)])


# -- learners ---------------------------------------------------------------


def boosted(
    mode: str = "regression",
    trees: int = 20,
    learn_rate: float = 0.1,
    min_n: int = 1,
    depth: int = 5,
    min_gain: float = 0.0,
    seed: int = 1,
    stop: str | None = None,
    fall: float = 0.01,
) -> Estimator:
    """Gradient-boosted trees. Spark's learn rates end at 1; a larger one is an error.

    With ``stop``, the name of a boolean column that marks validation rows, trees are added
    until the error of these falls by less than the share ``fall``, ``trees`` at most.
    """
    if not 0 < learn_rate <= 1:
        raise ValueError(f"a learn rate lies above 0 and up to 1, not at {learn_rate}")
    kind = GBTRegressor if mode == "regression" else GBTClassifier
    learner = kind(
        maxIter=trees,
        stepSize=learn_rate,
        minInstancesPerNode=min_n,
        maxDepth=depth,
        minInfoGain=min_gain,
        seed=seed,
    )
    return learner.setValidationIndicatorCol(stop).setParams(validationTol=fall) if stop else learner


def forest(
    mode: str = "classification", trees: int = 50, mtry: str = "auto", min_n: int = 1, depth: int = 5, seed: int = 1
) -> Estimator:
    kind = RandomForestRegressor if mode == "regression" else RandomForestClassifier
    return kind(
        numTrees=trees, featureSubsetStrategy=mtry, minInstancesPerNode=min_n, maxDepth=depth, seed=seed
    )


def tweedie(power: float = 1.5, penalty: float = 0.0) -> Estimator:
    """Log-link regression for targets with many zeros."""
    return GeneralizedLinearRegression(
        family="tweedie", variancePower=power, linkPower=0.0, regParam=penalty, maxIter=12
    )


def linear() -> Estimator:
    return LinearRegression(solver="normal")


def elastic_net(penalty: float, mixture: float) -> Estimator:
    return LinearRegression(regParam=penalty, elasticNetParam=mixture, maxIter=50)


def logistic(penalty: float = 0.0, mixture: float = 0.0) -> Estimator:
    return LogisticRegression(regParam=penalty, elasticNetParam=mixture, maxIter=50)


def network(inputs: int, units1: int, units2: int, seed: int = 1, steps: int = 40) -> Estimator:
    """Two hidden layers, trained by cross-entropy."""
    return MultilayerPerceptronClassifier(layers=[inputs, units1, units2, 2], seed=seed, maxIter=steps)


def clusters(k: int = 10, steps: int = 20, seed: int = 1) -> Estimator:
    return KMeans(k=k, maxIter=steps, seed=seed)


# -- fitting and using ------------------------------------------------------


def fit(design: Design, model: Estimator, train: DataFrame, by_profile: bool = False) -> PipelineModel:
    """Feature stages and learner, fitted together.

    ``by_profile`` adds up the rows with the same predictors before the learner reads them;
    see ``profiles``. Feature stages see every row either way.
    """
    if not by_profile:
        return workflow(design, model).fit(train)
    ready = Pipeline(stages=stages(design)).fit(train)
    # In order, so that a rerun draws the same profiles for its cut points.
    summed = profiles(design, model, train, "_n")
    rows = cut_lineage(summed.sortWithinPartitions(*[c for c in summed.columns if c not in ("_n", design.target)]))
    fitted = aimed(design, model).setWeightCol("_n").fit(ready.transform(rows))
    return PipelineModel([*ready.stages, fitted])


def profiles(design: Design, model: Estimator, train: DataFrame, count: str) -> DataFrame:
    """One row for all rows with the same predictors: their number as ``count``, the mean of their targets.

    Boosting with squared loss sees rows of a profile only through their number and the sum
    of their targets, so it grows the same trees; its cut points come from a sample of
    profiles, by their counts, in place of one of rows. Where every row has a profile of its
    own, nothing is gained. A learner that draws rows, counts them in a node or has another
    loss would not give the same and is an error. A null level is one like any other;
    unknown targets stay apart, for the learner to refuse.
    """
    if not isinstance(model, GBTRegressor) or model.getLossType() != "squared" or model.getMinInstancesPerNode() > 1 or model.getSubsamplingRate() < 1 or model.isSet("validationIndicatorCol"):
        raise ValueError("only boosting with squared loss on all rows, leaves of any size, can be fitted by profile")
    y = F.col(design.target).cast("double")
    predictors = dict.fromkeys([*design.numeric, *design.nominal, *design.hashed])
    sums = train.select(*predictors, y.alias("_y")).groupBy(*predictors, F.col("_y").isNull().alias("_unknown"))
    return sums.agg(F.count(F.lit(1)).cast("double").alias(count), F.avg("_y").alias(design.target)).drop("_unknown")


def fit_in_means(design: Design, model: Estimator, train: DataFrame) -> tuple[PipelineModel, float]:
    """Fit with the target counted in multiples of its mean; returns model and mean.

    A log-link fit starts from the target itself, with a fixed small number in
    place of zeros. It overshoots without return when the rest is far larger.
    """
    unit = train.agg(F.avg(design.target)).first()[0]
    return fit(design, model, train.withColumn(design.target, F.col(design.target) / unit)), unit


def probability(scored: DataFrame, out: str = "pred_prob") -> DataFrame:
    """Probability of the second class."""
    return scored.withColumn(out, vector_to_array("probability")[1])


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return tidy(model.transform(df), keep)


def tidy(scored: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns with the prediction, or with class and probability."""
    if "probability" in scored.columns:
        return probability(scored).select(*keep, F.col("prediction").alias("pred_class"), "pred_prob")
    return scored.select(*keep, "prediction")


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_names(scored: DataFrame, col: str = "features") -> list[str]:
    """Names of the slots of a feature vector, from its column metadata."""
    attrs = scored.schema[col].metadata["ml_attr"]["attrs"]
    slots = [a for kind in attrs.values() for a in kind]
    return [a["name"] for a in sorted(slots, key=lambda a: a["idx"])]


def learning_curve(model: PipelineModel, rows: dict[str, DataFrame], loss: str = "squared") -> DataFrame:
    """(rows, trees, error): the error of boosted trees on each table after every tree, and which count was kept.

    The model keeps the number of trees it stopped at, so the curve ends there.
    """
    last = model.stages[-1]
    found = []
    for name, df in rows.items():
        ready = PipelineModel(model.stages[:-1]).transform(df)
        kind = (loss,) if hasattr(last, "evaluateEachIteration") and "Regression" in type(last).__name__ else ()
        found += [(name, k, float(e)) for k, e in enumerate(last.evaluateEachIteration(ready, *kind), 1)]
    spark = next(iter(rows.values())).sparkSession
    return spark.createDataFrame(found, "rows string, trees int, error double")


def shuffled(df: DataFrame, key: Sequence[str], cols: Sequence[str], seed: int = 1, keep: Sequence[str] | None = None) -> DataFrame:
    """The rows, or their columns ``keep``, with each column of ``cols`` as _s_<name> too, dealt anew over all rows.

    One and the same random order serves all columns: the row at place i by key takes the
    values of the row at place i by a hash of the key. Both orders are numbered by ranges,
    so no task and no driver holds a column. Keys must be unique.
    """
    name = F.concat_ws("-", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    rows = cut_lineage(df)
    drawn = rows.select(F.unhex(F.md5(F.concat(name, F.lit(f"#{seed}")))).alias("_drawn"), *[F.col(c).alias(f"_s_{c}") for c in cols])
    given = row_index(drawn, "_drawn", "_place", keep=False)
    taking = row_index(rows.select(name.alias("_name"), *[c for c in df.columns if keep is None or c in keep]), "_name", "_place", keep=False)
    return taking.join(given, "_place").drop("_place")


def inputs(model: PipelineModel, columns: Sequence[str]) -> list[str]:
    """Those of the columns that a parameter of one of the model's stages names."""
    named = set()
    for value in (v for stage in model.stages for v in stage.extractParamMap().values()):
        named |= {value} if isinstance(value, str) else {v for v in value if isinstance(v, str)} if isinstance(value, (list, tuple)) else set()
    return [c for c in columns if c in named]


def permutation_importance(model: PipelineModel, df: DataFrame, key: Sequence[str], predictors: Sequence[str], target: str, error, seed: int = 1) -> DataFrame:
    """(feature, error, importance): how much the error of any fitted model grows when one predictor is dealt anew.

    ``error`` is an aggregate of the target and the prediction, such as ``metrics.rmse``.
    The rows are read once: each is scored as it is and with each predictor dealt anew.
    """
    needed = list(dict.fromkeys([*inputs(model, df.columns), target, *predictors]))
    rows = shuffled(df.select(*dict.fromkeys([*key, *needed])), key, predictors, seed, needed)
    ways = [F.struct(F.lit(k).alias("_way"), *[F.col(f"_s_{c}" if j == k else c).alias(c) for j, c in enumerate(predictors)]) for k in range(-1, len(predictors))]
    every = rows.select(*[c for c in needed if c not in predictors], F.inline(F.array(*ways)))
    errors = {r["_way"]: r["e"] for r in predict(model, every, ["_way", target]).groupBy("_way").agg(error(target, "prediction").alias("e")).collect()}
    base = errors.get(-1)
    out = [(c, errors.get(k), None if base is None or errors.get(k) is None else errors[k] - base) for k, c in enumerate(predictors)]
    return df.sparkSession.createDataFrame(out, "feature string, error double, importance double")


def importance(model: PipelineModel, scored: DataFrame, spark: SparkSession) -> DataFrame:
    """(feature, importance): impurity shares of trees or sizes of coefficients."""
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    col = last.getFeaturesCol()
    source = "raw_features" if "raw_features" in scored.columns else col
    rows = list(zip(feature_names(scored, source), [float(v) for v in values.toArray()]))
    return spark.createDataFrame(rows, "feature string, importance double")
