"""Shared parts of the numpy-trained classifiers: bounded labelled samples, Adam, stable activations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Adam:
    """Adam over a dict of arrays, updated in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        a, b = 1 - 0.9 ** self.step, 1 - 0.999 ** self.step
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (self.rate * (self.m[k] / a) / (np.sqrt(self.v[k] / b) + 1e-8)).astype(self.params[k].dtype)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, learns, rows: int, chars: int) -> pd.DataFrame:
    """(text, y) of at most ``rows`` labelled documents that ``learns`` (a condition on doc_id) admits, of which no text
    is longer than ``chars``: those first by a hash of doc_id and label, in that order, so sample and order are the same at
    every partitioning. Documents with a null text or label don't teach; of several texts under one id the smallest does.
    Only ids and labels are joined and ranked; then the chosen ids, of which there are ``rows`` at most, are sent to the
    scan that reads their texts, and the driver puts the rows in order."""
    known = labels.filter(F.col(target).isNotNull()).select("doc_id", F.col(target).cast("int").alias("y")).distinct()
    some = docs.select("doc_id", "text").filter("text is not null").filter(learns).filter(F.length("text") <= chars)
    ranked = some.select("doc_id").join(known, "doc_id").distinct().withColumn("_order", F.xxhash64("doc_id", "y"))
    chosen = ranked.orderBy("_order", "doc_id", "y").limit(rows)
    texts = some.join(F.broadcast(chosen), "doc_id").groupBy("_order", "doc_id", "y").agg(F.min("text").alias("text"))
    return texts.toPandas().sort_values(["_order", "doc_id", "y"], ignore_index=True)[["text", "y"]]


def learns(parts: int, held: int):
    return fold(F.col("doc_id"), parts) != F.lit(held)
