"""Fitted models by version, and the alias under which one of them scores.

Every training run registers its fitted pipeline with its figures. The gate decides by
the figures of all versions which one is champion; scoring loads that one by its alias,
and its version goes into the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.operators.evaluation import accuracy, auc
from offerloom.operators.model import fit_propensity, predict_proba, prepare
from offerloom.operators.promotion import current_aliases, promotion_ledger
from offerloom.session import staged
from offerloom.sources import versioned

CHAMPION, CHALLENGER = "champion", "challenger"
VERSION_SCHEMA = (
    "model string, version int, run_id string, folder string, auc double, accuracy double, n bigint, registered_at timestamp_ntz"
)


@dataclass(frozen=True)
class ModelStore:
    """Models under one path: a folder per fitted pipeline, and a versioned table of their figures."""

    spark: SparkSession
    path: str
    model: str = "propensity"

    @property
    def _table(self) -> str:
        return f"{self.path}/versions"

    def versions(self) -> DataFrame:
        """A row per registered version; few, as each stands for a training run."""
        if versioned.version(self.spark, self._table) is None:
            return self.spark.createDataFrame([], VERSION_SCHEMA)
        return versioned.read_version(self.spark, self._table)

    def register(self, fitted: PipelineModel, figures: Mapping[str, object], at: str) -> int:
        """Store a fitted pipeline as the next version; `figures` are auc, accuracy and n on held-out rows.

        The pipeline is written first, so a version that can be seen can be loaded. Of two
        runs that register at once, one gets a Conflict and may try again.
        """
        known = self.versions().filter(F.col("model") == self.model)
        version = (known.agg(F.max("version")).first()[0] or 0) + 1
        folder = f"model-{uuid.uuid4().hex}"
        fitted.write().save(f"{self.path}/{folder}")
        row = (self.model, version, f"{self.model}-{version}", folder, figures["auc"], figures["accuracy"], figures["n"])
        new = self.spark.createDataFrame([row], VERSION_SCHEMA.rsplit(",", 1)[0])
        new = new.withColumn("registered_at", F.lit(at).cast("timestamp_ntz"))
        versioned.write_version(self.versions().unionByName(new).coalesce(1), self._table)
        return version

    def aliases(self) -> DataFrame:
        """(model, alias, version): what the gate says after the last registration."""
        return current_aliases(promotion_ledger(self.versions()))

    def load(self, alias: str = CHAMPION) -> tuple[PipelineModel, int]:
        """The pipeline behind an alias, and its version."""
        at = self.aliases().filter((F.col("model") == self.model) & (F.col("alias") == alias))
        found = at.join(self.versions(), ["model", "version"]).select("version", "folder").first()
        if found is None:
            raise LookupError(f"{self.model} has no {alias}")
        return PipelineModel.load(f"{self.path}/{found['folder']}"), found["version"]


def figures_of(fitted: PipelineModel, held_out: DataFrame, label: str = "accepted") -> dict[str, object]:
    """auc, accuracy and n on rows that were not trained on."""
    scored = staged(predict_proba(fitted, held_out).select(label, "p_accept"), "held-out-scores")
    hits = accuracy(scored, "p_accept", label).first()
    return {"auc": auc(scored, "p_accept", label).first()["auc"], "accuracy": hits["accuracy"], "n": hits["n"]}


def train_and_gate(
    store: ModelStore, train: DataFrame, held_out: DataFrame, settings: Iterable[Mapping[str, object]], at: str, label: str = "accepted"
) -> None:
    """Fit and register a version for each set of parameters; the gate follows from their figures.

    Stage the held-out rows first; every version is scored on them.
    """
    ready = prepare(train, label)
    for params in settings:
        fitted = fit_propensity(ready, label, **params)
        store.register(fitted, figures_of(fitted, held_out, label), at)


def score_with_champion(store: ModelStore, grid: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """`grid` with the champion's p_accept and model_version, computed on the executors without Python."""
    fitted, version = store.load(CHAMPION)
    scored = predict_proba(fitted, grid).withColumn("model_version", F.lit(version).cast("int"))
    return scored if columns is None else scored.select(*columns)
