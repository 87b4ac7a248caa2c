"""Fitting small models on a bounded, deterministic sample of labelled rows.

Iterative parameter mixing: in every round each shard of the sample improves a copy of the
parameters inside a Spark task, and the driver averages the copies. Only the parameters
(their size is fixed) travel to the driver and back.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnmetrics.llm.common import stored

#: Shards of the sample, fitted side by side; most label values that a model learns.
SHARDS = 6
MAX_LABELS = 256


def _chosen(rows: DataFrame, keys: list[str], per_label: int, seed: int, labels: int) -> DataFrame:
    """At most ``per_label`` of ``rows`` (of distinct ``keys``) per label, with their hash ``o``.

    Rows are first thinned to about twice those wanted by the value of their hash, so that a
    label of a third of all rows is not ranked in one task; only what is left is ranked.
    """
    hashed = rows.withColumn("o", F.xxhash64(F.lit(seed), *keys))
    counts = hashed.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(labels)
    share = (F.lit(2.0 * per_label) + 64) / F.col("n")  # more than per_label rows pass, whatever the hash
    uniform = F.shiftrightunsigned("o", 11) / F.lit(float(1 << 53))
    thin = hashed.join(F.broadcast(counts), "label").where(uniform < share).drop("n")
    window = Window.partitionBy("label").orderBy("o", *keys)
    return thin.withColumn("r", F.row_number().over(window)).where(F.col("r") <= per_label).drop("r")


def bounded_sample(
    docs: DataFrame, labels: DataFrame, per_label: int, seed: int = 1, most_labels: int = MAX_LABELS, shards: int = SHARDS
) -> DataFrame:
    """Columns doc, text, label, shard of at most ``per_label`` rows per label value, for the
    ``most_labels`` most frequent values (of equally frequent ones, those that sort first).

    ``labels`` has doc and label; ``docs`` has doc and text and, where a row's label is its
    own, label too: a text is then only learned with that. Ids are chosen by a hash before any
    text is read, so what is broadcast is bounded by ``per_label`` times ``most_labels``. Then
    the rows of those ids are chosen in the same way: a repeated row counts once, and an id of
    a million rows has no more than ``per_label`` of them.
    """
    on = ["doc", "label"] if "label" in docs.columns else ["doc"]
    ids = labels.where("doc is not null and label is not null").select("doc", "label").distinct()
    rows = docs.join(F.broadcast(_chosen(ids, ["doc"], per_label, seed, most_labels).select("doc", "label")), on)
    rows = rows.groupBy("doc", "label", F.xxhash64("text").alias("t")).agg(F.first("text").alias("text"))
    sample = _chosen(stored(rows, "labelled"), ["doc", "t"], per_label, seed, most_labels)
    return stored(sample.select("doc", "text", "label", F.pmod("o", F.lit(shards)).cast("int").alias("shard")), "sample")


def mixed(sample: DataFrame, parameters: dict, fit: Callable[[dict, pd.DataFrame, int], dict], rounds: int) -> dict:
    """``parameters`` after ``rounds`` of local fitting and averaging; None if the sample is empty.

    ``fit(parameters, rows, round)`` gets one shard's rows in id order.
    """

    def shard_fit(start: dict, turn: int):
        def one(rows: pd.DataFrame) -> pd.DataFrame:
            found = fit({k: v.copy() for k, v in start.items()}, rows.sort_values(["doc", "text"]).reset_index(drop=True), turn)
            return pd.DataFrame({"rows": [len(rows)], "model": [pickle.dumps(found)]})

        return one

    for turn in range(rounds):
        parts = sample.groupBy("shard").applyInPandas(shard_fit(parameters, turn), "rows long, model binary").collect()
        if not parts:
            return None
        parts.sort(key=lambda r: (r["rows"], bytes(r["model"])))
        total = sum(r["rows"] for r in parts)
        models = [(r["rows"] / total, pickle.loads(bytes(r["model"]))) for r in parts]
        parameters = {k: sum(w * m[k].astype(np.float64) for w, m in models).astype(np.float32) for k in parameters}
    return parameters


class Adam:
    """Adam steps over a dictionary of arrays, in place."""

    def __init__(self, parameters: dict, rate: float):
        self.p, self.rate, self.t = parameters, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.v = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradients: dict) -> None:
        self.t += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
            self.p[k] -= scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)
