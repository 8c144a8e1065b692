"""Split, fit, score, evaluate, compare and keep track of the cancellation classifier."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeline.functions.columns import CLASS_INDEX, decode_label, hash_share, key_hash
from lodgeline.operators.cleaning import require
from lodgeline.schemas import KEY, TARGET, Roles

# Solver settings and the decision threshold.
C = 1.0
MAX_ITER = 1000
THRESHOLD = 0.5
LATEST_ALIAS = "latest-model"
READY = "READY"

MODEL_BYTES = 256 << 20  # a model that is broadcast
MAX_LEVELS = 10_000  # levels of a column that may reach the driver

Scorer = Callable[[DataFrame], DataFrame]


# Split


def with_split(df: DataFrame, test: float = 0.2, key: str = KEY) -> DataFrame:
    """Mark rows train or test by a hash of their key: the same rows every time, without a shuffle."""
    return df.withColumn("split", F.when(key_hash(key) < hash_share(test), "test").otherwise("train"))


def split(df: DataFrame, test: float = 0.2, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    held_out = key_hash(key) < hash_share(test)
    return df.filter(~held_out), df.filter(held_out)


# Encoding and fit


def levels_of(df: DataFrame, columns: Sequence[str], most: int = MAX_LEVELS) -> tuple[int, dict[str, list[str]]]:
    """Number of rows and the sorted non-null levels of each column.

    The levels of a column reach the driver, so they are counted first: more than about `most` are an error.
    """
    about = df.agg(*[F.approx_count_distinct(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    many = [c for i, c in enumerate(columns) if about[f"s{i}"] > most]
    if many:
        raise ValueError(f"more than {most} levels in {', '.join(many)}")
    sets = [F.array_sort(F.collect_set(c)).alias(f"s{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count("*").alias("n"), *sets).first()
    return row["n"], {c: row[f"s{i}"] for i, c in enumerate(columns)}


def encoder(columns: Sequence[str], levels: Mapping[str, list[str]]) -> list:
    """One-hot of every level of the columns; a level not listed, or none, gives all zeros."""
    indexers = [
        StringIndexerModel.from_labels(levels[c], inputCol=c, outputCol=f"_{c}_index", handleInvalid="keep")
        for c in columns
    ]
    indexed, hot = [f"_{c}_index" for c in columns], [f"_{c}_hot" for c in columns]
    return [*indexers, OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True)]


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every level of the columns as a 0/1 column `<column>=<level>`."""
    _, levels = levels_of(df, columns)
    encoded = Pipeline(stages=encoder(columns, levels)).fit(df).transform(df)
    cells = [
        vector_to_array(f"_{c}_hot")[i].cast("int").alias(f"{c}={level}")
        for c in columns
        for i, level in enumerate(levels[c])
    ]
    return encoded.select(*df.columns, *cells)


def fit_lr(
    train: DataFrame, roles: Roles = Roles(), c: float = C, max_iter: int = MAX_ITER, tol: float = 1e-6
) -> PipelineModel:
    """Logistic regression with an L2 penalty of strength 1/c on the summed loss.

    Features are the one-hot levels, then the raw numbers; rows without target or with a missing number are not fitted.
    Spark averages the loss, so the penalty is divided by the number of rows fitted. The target must have two levels.
    The solver keeps its blocks of rows in executor memory or on executor disk.
    """
    rows = train.filter(F.col(roles.target).isNotNull() & _complete(roles.num_features))
    cats = list(roles.cat_features)
    n, levels = levels_of(rows, [roles.target, *cats])
    if len(levels[roles.target]) != 2:
        raise ValueError(f"{roles.target} has {len(levels[roles.target])} levels in the rows to fit, expected 2")
    target = StringIndexerModel.from_labels(levels[roles.target], inputCol=roles.target, outputCol="_label")
    vector = VectorAssembler(
        inputCols=[*[f"_{c}_hot" for c in cats], *roles.num_features], outputCol="_features", handleInvalid="keep"
    )
    lr = LogisticRegression(
        featuresCol="_features",
        labelCol="_label",
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
        probabilityCol="_probability",
        predictionCol="_prediction",
        rawPredictionCol="_raw",
    )
    return Pipeline(stages=[target, *encoder(cats, levels), vector, lr]).fit(rows)


def coefficients(model: PipelineModel, roles: Roles = Roles()) -> list[tuple[str, float]]:
    """Feature names and coefficients in vector order, the intercept last."""
    names = []
    for c, indexer in zip(roles.cat_features, model.stages[1:]):
        names += [f"{c}={level}" for level in indexer.labels]
    lr = model.stages[-1]
    values = [float(v) for v in lr.coefficients]
    return [*zip([*names, *roles.num_features], values, strict=True), ("intercept", float(lr.intercept))]


# Scoring


def _answers(probability: Column, prefix: str = "") -> dict[str, Column]:
    """Class, label and probability of the second class, which wins from the threshold on."""
    wins = F.when(probability >= THRESHOLD, 1).when(probability < THRESHOLD, 0)
    return {
        f"{prefix}prediction": wins,
        f"{prefix}label": decode_label(wins, CLASS_INDEX),
        f"{prefix}probability": probability,
    }


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All rows with prediction, label and probability, which are null where a number is missing."""
    scorer = PipelineModel(stages=model.stages[1:])
    out = scorer.transform(df)
    probability = vector_to_array("_probability")[1]
    known = F.when(~F.isnan(probability), probability)
    return out.withColumns(_answers(known)).select(
        *df.columns, "prediction", "label", "probability"
    )


def _complete(columns: Sequence[str]) -> Column:
    """Whether all these numbers are there."""
    there = F.lit(True)
    for c in columns:
        there = there & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return there


def linear(coefficients: Mapping[str, float], intercept: float) -> Column:
    z = F.lit(float(intercept))
    for c, w in coefficients.items():
        z = z + F.lit(float(w)) * F.col(c)
    return z


def score_linear(df: DataFrame, coefficients: Mapping[str, float], intercept: float, prefix: str = "") -> DataFrame:
    """Score with given coefficients; a row with a missing feature gets nulls."""
    probability = 1 / (1 + F.exp(-linear(coefficients, intercept)))
    return df.withColumns(_answers(probability, prefix))


def score_map_in_pandas(df: DataFrame, coefficients: Mapping[str, float], intercept: float) -> DataFrame:
    """The same scores from a model that is only callable from Python, fed Arrow batches."""
    columns, weights = list(coefficients), np.array(list(coefficients.values()))
    threshold, names = THRESHOLD, {code: label for label, code in CLASS_INDEX.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = intercept + batch[columns].to_numpy(dtype="float64") @ weights
            probability = pd.Series(1 / (1 + np.exp(-z)), index=batch.index)
            known = probability.notna()
            wins = (probability >= threshold).astype("Int32").where(known)
            yield pd.DataFrame(
                {KEY: batch[KEY], "prediction": wins, "label": wins.map(names), "probability": probability}
            )

    schema = f"{KEY} string, prediction int, label string, probability double"
    return df.select(KEY, *columns).mapInPandas(run, schema)


#: What a Python model gives: the probability of the second class for each row of a matrix of its columns.
Predict = Callable[[np.ndarray], np.ndarray]


def score_model(df: DataFrame, load: Callable[[], Predict], columns: Sequence[str], batch_size: int = 8192) -> DataFrame:
    """All rows with the answers of any Python model: prediction, label and probability.

    `load` is called once in each worker process, for instance to unpickle a broadcast model or to read a file that all
    workers can reach, and returns the model's function. It gets batches of rows with all their numbers; rows with a
    missing number get null answers. Class and label follow from the probability in the JVM.
    """
    require(df, columns)

    def make():
        predict = load()

        def run(rows: np.ndarray) -> np.ndarray:
            known = ~np.isnan(rows).any(axis=1)
            out = np.full(len(rows), np.nan)
            if known.any():
                out[known] = np.asarray(predict(rows[known]), dtype="float64").reshape(-1)
            return out

        return run

    model = predict_batch_udf(make, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=[[len(columns)]])
    # A null would come as a missing value of its own; NaN is one for every model.
    cells = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns]
    scored = df.withColumn("_probability", model(F.array(*cells)))
    known = F.when(~F.isnan("_probability"), F.col("_probability"))
    return scored.withColumns(_answers(known)).drop("_probability")


def broadcast_model(spark: SparkSession, model: object, predict: Callable[[object, np.ndarray], np.ndarray]) -> Callable[[], Predict]:
    """A loader for `score_model` of a model that is sent to every worker once, of `MODEL_BYTES` pickled bytes at most."""
    size = len(pickle.dumps(model))
    if size > MODEL_BYTES:
        raise ValueError(f"a model of {size} bytes is too large to be broadcast; let `load` read it from a shared folder")
    shared = spark.sparkContext.broadcast(model)

    def load() -> Predict:
        own = shared.value
        return lambda rows: predict(own, rows)

    return load


def score_incremental(
    table: DataFrame, scorer: Scorer, prediction: str, proba: str, key: str = KEY
) -> DataFrame:
    """Table in which rows without a prediction got one; as many rows come back as went in.

    Scored and unscored rows are told apart by a pushed filter. The scorer must keep all its rows, with nulls where it
    has no answer, as `score` and `score_linear` do; so no join is needed to put them back.
    """
    todo = table.filter(F.col(prediction).isNull()).drop(prediction, proba)
    scored = scorer(todo)
    done = scored.withColumns({prediction: F.col("label"), proba: F.col("probability")}).select(*table.columns)
    return table.filter(F.col(prediction).isNotNull()).unionByName(done)


# Evaluation


def weighted_metrics_of(counts: DataFrame, label: str, prediction: str, n: str = "n") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 from a frame of label, prediction, count.

    A class that is never predicted has precision 0, and F1 0. The frame has a row per pair of
    classes, so what follows the first grouping is tiny.
    """
    hit = F.when(F.col(label) == F.col(prediction), F.col(n)).otherwise(F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    known = F.col(label).isNotNull()
    # Each grouped row counts for its class and for the class that was predicted; the frame is read once.
    sides = F.array(
        F.struct(F.col(label).alias("class"), hit.alias("tp"), F.col(n).alias("support"), zero.alias("predicted")),
        F.struct(F.col(prediction).alias("class"), zero.alias("tp"), zero.alias("support"), F.col(n).alias("predicted")),
    )
    both = counts.filter(known).select(F.explode(sides).alias("s")).select("s.*").filter(F.col("class").isNotNull())
    per_class = both.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted")
    )
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    support = F.sum("support")
    return per_class.agg(
        (F.sum("tp") / support).alias("accuracy"),
        (F.sum(F.col("support") * precision) / support).alias("precision"),
        (F.sum(F.col("support") * recall) / support).alias("recall"),
        (F.sum(F.col("support") * f1) / support).alias("f1_score"),
    )


def weighted_metrics(df: DataFrame, label: str = TARGET, prediction: str = "label") -> DataFrame:
    return weighted_metrics_of(df.groupBy(label, prediction).agg(F.count("*").alias("n")), label, prediction)


def champion_gate(df: DataFrame, label: str, challenger: str, champion: str | None) -> DataFrame:
    """Both F1 scores over the same rows, and whether the challenger is at least as good.

    Without a champion the challenger passes. Both models' outcomes are counted together, and all else is done on the
    counts.
    """
    models = [challenger, *([champion] if champion else [])]
    counts = df.groupBy(label, *models).agg(F.count("*").alias("n"))

    def f1(model: str, name: str) -> DataFrame:
        pairs = counts.groupBy(label, model).agg(F.sum("n").alias("n"))
        return weighted_metrics_of(pairs, label, model).select(F.col("f1_score").alias(name))

    out = f1(challenger, "f1_challenger")
    if champion:
        out = out.crossJoin(F.broadcast(f1(champion, "f1_champion")))
    else:
        out = out.withColumn("f1_champion", F.lit(None).cast("double"))
    better = F.coalesce(F.col("f1_challenger") >= F.col("f1_champion"), F.lit(champion is None))
    return out.withColumn("register", better)


# Registry and run log, kept as tables


def registry_latest(registry: DataFrame, name: str | None = None) -> DataFrame:
    """Version to serve per model: the one with the latest alias, else the greatest ready one.

    `registry` has the versions, or the events of `tracking.registry_of`.
    """
    if "event_id" in registry.columns and "version" not in registry.columns:
        from lodgeline.operators.tracking import registry_of

        registry = registry_of(registry)
    rows = registry if name is None else registry.filter(F.col("model_name") == name)
    aliased = F.max(F.when(F.col("alias") == LATEST_ALIAS, F.col("version")))
    ready = F.max(F.when(F.col("status") == READY, F.col("version")))
    found = rows.groupBy("model_name").agg(aliased.alias("aliased"), ready.alias("ready"))
    return found.select(
        "model_name",
        F.coalesce("aliased", "ready").alias("version"),
        F.when(F.col("aliased").isNotNull(), "alias").when(F.col("ready").isNotNull(), "ready").alias("found_by"),
    ).filter(F.col("version").isNotNull())


def register_version(registry: DataFrame, name: str, status: str = READY) -> DataFrame:
    """Registry with the next version of a model, which takes over the latest alias."""
    last = registry.filter(F.col("model_name") == name).agg(F.max("version").alias("v"))
    new = last.select(
        F.lit(name).alias("model_name"),
        (F.coalesce("v", F.lit(0)) + 1).cast("bigint").alias("version"),
        F.lit(status).alias("status"),
        F.lit(LATEST_ALIAS).alias("alias"),
    )
    holds = (F.col("model_name") == name) & (F.col("alias") == LATEST_ALIAS)
    return registry.withColumn("alias", F.when(~F.coalesce(holds, F.lit(False)), F.col("alias"))).unionByName(new, allowMissingColumns=True)


def run_log(
    metrics: DataFrame, run_id: str, params: Mapping[str, str], source: str, as_of: Column, source_version: str | None = None
) -> DataFrame:
    """One row of a run: its parameters, metrics, input table and the version of what was in it."""
    names = [c for c in metrics.columns]
    pairs = F.create_map(*[p for c in names for p in (F.lit(c), F.col(c).cast("double"))])
    settings = F.create_map(*[F.lit(x) for kv in params.items() for x in kv])
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        as_of.alias("logged_at"),
        F.lit(source).alias("source"),
        F.lit(source_version).cast("string").alias("source_version"),
        settings.alias("params"),
        pairs.alias("metrics"),
    )


# Input checks


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns whose type differs from the recorded one, and how many values would not convert.

    A missing column has no actual type and counts all rows. All columns are checked in one pass.
    """
    actual = {f.name: f.dataType for f in df.schema}
    off = [f for f in expected if actual.get(f.name) != f.dataType]
    if not off:
        return df.sparkSession.createDataFrame([], "column string, expected string, actual string, bad_rows bigint")

    def bad(f: T.StructField) -> Column:
        if f.name not in actual:
            return F.count("*")
        lost = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        return F.count(F.when(lost, 1))

    wide = df.agg(*[bad(f).alias(f.name) for f in off])
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("expected"),
                F.lit(actual[f.name].simpleString() if f.name in actual else None).cast("string").alias("actual"),
                F.col(f.name).alias("bad_rows"),
            )
            for f in off
        ]
    )
    return wide.select(F.inline(rows))
