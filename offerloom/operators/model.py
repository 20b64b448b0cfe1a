"""Propensity model: a Spark ML pipeline whose trees are grown by `boosting`."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.operators import boosting
from offerloom.operators.evaluation import accuracy, auc
from offerloom.operators.features import FEATURES
from offerloom.operators.scoring import SCORE_DIGITS
from offerloom.session import given_up, shared_dir, staged

# Parameters of the full-size training run.
FULL_ROUNDS = 200
LEARNING_RATE = 0.08
DEPTH = 6
SEED = 42
BINS = 32

INPUTS = (*FEATURES, "level")


def to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Widen the numeric model inputs."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def counted(train: DataFrame, label: str) -> DataFrame:
    """Distinct training rows, each with how often it occurs as `weight`.

    A round reads each row once for every level of its tree, so equal rows are read as
    one that weighs as much. No row is left out, and the sums behind the splits are the same.
    """
    same = ["offer_type", *INPUTS, label]
    return to_double(train.select(*same), [*INPUTS, label]).groupBy(*same).agg(F.count("*").cast("double").alias("weight"))


@dataclass(frozen=True)
class Prepared:
    """What all fits to the same rows share: the fitted stages before the trees, and the rows in cells."""

    stages: tuple
    held: boosting.Cells


def prepare(train: DataFrame, label: str = "accepted") -> Prepared:
    """Offer types (an unknown one is all zero), level and features as one vector, and equal rows as one with a weight."""
    rows = staged(counted(train, label), "counted")
    stages = [
        StringIndexer(inputCol="offer_type", outputCol="type_index", handleInvalid="keep"),
        OneHotEncoder(inputCol="type_index", outputCol="type_vector", dropLast=True),
        VectorAssembler(inputCols=["type_vector", *INPUTS], outputCol="inputs"),
    ]
    fitted = Pipeline(stages=stages).fit(rows)
    held = boosting.cells(fitted.transform(rows), "inputs", label, "weight", BINS)
    given_up(rows)
    return Prepared(tuple(fitted.stages), held)


def fit_propensity(
    train: DataFrame | Prepared,
    label: str = "accepted",
    rounds: int = FULL_ROUNDS,
    learning_rate: float = LEARNING_RATE,
    depth: int = DEPTH,
    seed: int = SEED,
) -> PipelineModel:
    """Boosted trees over the offer type (an unknown type is all zero), level and features; equal rows are weighted."""
    ready = train if isinstance(train, Prepared) else prepare(train, label)
    ready.held.table.sparkSession.sparkContext.setCheckpointDir(shared_dir(ready.held.table.sparkSession))
    settings = GBTClassifier(
        featuresCol="inputs",
        labelCol=label,
        weightCol="weight",
        maxIter=rounds,
        maxDepth=depth,
        maxBins=BINS,
        stepSize=learning_rate,
        seed=seed,
    )
    return PipelineModel([*ready.stages, boosting.boosted(ready.held, settings)])


def predict_proba(model: PipelineModel, df: DataFrame) -> DataFrame:
    """`df` with the probability of acceptance, computed on the executors without Python."""
    inputs = [c for c in ("offer_type", *INPUTS) if c in df.columns]
    scored = model.transform(to_double(df.select(F.struct(*df.columns).alias("_row"), *inputs), INPUTS))
    p = F.round(vector_to_array("probability")[1], SCORE_DIGITS).alias("p_accept")
    return scored.select("_row.*", p)


def sweep(train: DataFrame, test: DataFrame, grid: Iterable[Mapping[str, object]], label: str = "accepted") -> DataFrame:
    """One row per parameter set with its test AUC and accuracy.

    Stage the test rows first; every fit is scored on them.
    """
    spark = train.sparkSession
    runs, train = None, prepare(train, label)
    for n, params in enumerate(grid, 1):
        scored = predict_proba(fit_propensity(train, label, **params), test)
        row = (
            auc(scored, "p_accept", label)
            .drop("n")
            .withColumn("one", F.lit(1))
            .join(accuracy(scored, "p_accept", label).drop("n").withColumn("one", F.lit(1)), "one")
            .select(
                F.lit(f"run-{n:03d}").alias("run_id"),
                F.lit(len(FEATURES)).alias("n_features"),
                *[F.lit(v).alias(k) for k, v in sorted(params.items())],
                "auc",
                "accuracy",
            )
        )
        done = spark.createDataFrame(row.collect(), row.schema)
        runs = done if runs is None else runs.unionByName(done)
    return runs
