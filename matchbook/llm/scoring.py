"""Shared by the trained classifiers: the bounded labelled sample, and scoring as one narrow scan."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import fold, prepared


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """text and label of at most ``rows`` labelled documents outside the held-out fold.

    The label rows are cut to ``rows`` by the hash of their id before they meet the documents, so the side
    that is broadcast has at most ``rows`` narrow rows. An id labelled twice counts as its larger label;
    null or other labels are left out.
    """
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("__label").alias("label"))


def scored(docs: DataFrame, score: Callable, schema: str, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` and what ``score`` gives for the texts: one scan, no shuffle.

    ``score(batches)`` takes Arrow batches with ``columns`` and a text column, and yields, for each run of
    rows, the rows and a dict of result arrays.
    """
    prepared(docs.sparkSession)
    source = docs.select(*columns, F.col("text").cast("string").alias("__text"))
    names = columns

    def run(batches):
        for rows, results in score(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index(c)) for c in names] + [pa.array(v) for v in results.values()],
                names=[*names, *results],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return source.mapInArrow(run, f"{fields}, {schema}")


def adam(params: list[np.ndarray], steps: int, rate: float, gradient: Callable[[int], list[np.ndarray]]) -> None:
    """Adam in place; ``gradient(step)`` gives the gradient of a minibatch for each parameter."""
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        step = rate * min(1.0, 2.0 * (1 - (t - 1) / steps))
        for p, g, m, v in zip(params, gradient(t), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
