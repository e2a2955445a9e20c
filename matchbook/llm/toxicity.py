"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its lower-cased words without outer punctuation, and each word's first four and five
letters, hashed to ``2**BITS`` buckets; a bucket is present or not. The score is
``sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``: the factors ``v`` learn what pairs of terms
add, such as an insult next to a group's name, beyond the additive weights. Only buckets that tell
about the label have weights: by themselves (their deviance over the training sample), or as one of a pair whose
deviance exceeds that of its two buckets, so that a term which matters only next to another is not sieved out.

Training takes at most ``TRAIN_ROWS`` labelled documents (whole texts); scoring is one scan over every
whole text. Defined results: a null or empty text has no terms and gets the bias alone, ``sigmoid(w0)``;
without labels every score is 0; repeated rows score alike. Extra columns of any name are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import fold, prepared
from matchbook.llm.scoring import adam, labelled_sample, scored, sigmoid

BITS = 20
#: Bound of the labelled sample, of the buckets with weights, and length of a factor.
TRAIN_ROWS = 10_000
BUCKETS = 4096
FACTORS = 8
THRESHOLD = 0.7
#: A bucket needs this much log-likelihood gain over the base rate to have a weight.
MIN_GAIN = 5.0
#: Buckets whose pairs are looked at (the most frequent of those in 20 texts or more, but not in most), and the gain
#: that a pair needs beyond its buckets' own (few of two million chance pairs reach it).
PAIR_BUCKETS = 2048
PAIR_TEXTS = 20
MIN_PAIR_GAIN = 15.0
OUTER = " \t\r\n.,;:!?\"'()[]{}<>|*#$%&-_/\\=+~`"


def term_ids(token: str) -> tuple[int, ...]:
    """Buckets of one white-space token: the word and its beginnings of four and five letters."""
    word = token.strip(OUTER).lower()
    if not word:
        return ()
    terms = [word] + [f"{word[:n]}^" for n in (4, 5) if len(word) >= n]
    return tuple(zlib.crc32(t.encode()) & ((1 << BITS) - 1) for t in terms)


def text_ids(text: str | None, memo: dict, limit: int = 400_000) -> np.ndarray:
    """Distinct buckets of a whole text; ``memo`` keeps the buckets of tokens seen, up to ``limit``."""
    found: set[int] = set()
    for token in set((text or "").split()):
        ids = memo.get(token)
        if ids is None:
            if len(memo) >= limit:
                memo.clear()
            ids = memo[token] = term_ids(token)
        found.update(ids)
    return np.fromiter(found, np.int32, len(found))


@dataclass
class FactorizationMachine:
    """Bias, and for each kept bucket (ascending) its weight and factors."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    trained: bool = True

    def margin(self, rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """rows: which text; at: position of a kept bucket in it. Returns a margin for each of n texts."""
        linear = np.bincount(rows, self.weights[at], n)
        total = np.zeros((n, self.factors.shape[1]))
        v = self.factors[at]
        np.add.at(total, rows, v)
        squares = np.bincount(rows, (v * v).sum(1), n)
        return self.bias + linear + 0.5 * ((total * total).sum(1) - squares)


def gains(pos: np.ndarray, seen: np.ndarray, rate: float) -> np.ndarray:
    """Log-likelihood gain of knowing the label rate among ``seen`` texts, ``pos`` of them labelled 1."""
    neg = seen - pos
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(pos > 0, pos * np.log(pos / (seen * rate)), 0) + np.where(neg > 0, neg * np.log(neg / (seen * (1 - rate))), 0)


def paired_buckets(ids: list[np.ndarray], y: np.ndarray, seen: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Buckets of the pairs that tell more about the label than their two buckets do."""
    usual = np.flatnonzero((seen >= PAIR_TEXTS) & (seen <= 0.6 * len(y)))
    usual = np.sort(usual[np.argsort(-seen[usual], kind="stable")[:PAIR_BUCKETS]])
    both, toxic = np.zeros((2, len(usual), len(usual)), np.float32)
    for begin in range(0, len(ids), 2048):  # bounded rows at a time
        part = ids[begin : begin + 2048]
        x = np.zeros((len(part), len(usual)), np.float32)
        for i, t in enumerate(part):
            x[i, np.searchsorted(usual, t[np.isin(t, usual)])] = 1
        both += x.T @ x
        labelled = x[y[begin : begin + 2048] == 1]
        toxic += labelled.T @ labelled
    more = gains(toxic, both, y.mean()) - gain[usual][:, None] - gain[usual][None, :]
    more[both < PAIR_TEXTS] = 0
    np.fill_diagonal(more, 0)
    i, j = np.nonzero(np.triu(more) > MIN_PAIR_GAIN)
    best = np.argsort(-more[i, j], kind="stable")[: BUCKETS // 2]
    return np.unique(usual[np.concatenate([i[best], j[best]])])


def select_buckets(ids: list[np.ndarray], y: np.ndarray, keep: int) -> np.ndarray:
    """The buckets with the largest gain, and those of pairs with a gain of their own."""
    size = 1 << BITS
    pos, seen = np.zeros(size), np.zeros(size)
    for x, label in zip(ids, y, strict=True):
        seen[x] += 1
        if label:
            pos[x] += 1
    gain = gains(pos, seen, y.mean())
    gain[seen == 0] = 0
    best = np.argpartition(-gain, min(keep, size - 1))[:keep]
    return np.union1d(best[gain[best] > MIN_GAIN], paired_buckets(ids, y, seen, gain))


def fit_machine(ids: list[np.ndarray], y: np.ndarray, steps: int = 1500, seed: int = 3) -> FactorizationMachine:
    """Adam on the logistic loss with L2, minibatches of 256 texts, classes weighed alike."""
    empty = FactorizationMachine(0.0, np.zeros(0, np.int32), np.zeros(0), np.zeros((0, FACTORS)), False)
    if not len(y):
        return empty
    if y.min() == y.max():
        empty.bias, empty.trained = (4.0 if y[0] else -4.0), True
        return empty
    buckets = select_buckets(ids, y, BUCKETS)
    found = [np.searchsorted(buckets, x[np.isin(x, buckets)]) for x in ids]
    rng = np.random.default_rng(seed)
    pos = np.zeros(len(buckets))
    neg = np.zeros(len(buckets))
    for x, label in zip(found, y, strict=True):
        (pos if label else neg)[x] += 1
    prior = np.log((pos + 0.3) / (y.sum() + 0.6)) - np.log((neg + 0.3) / (len(y) - y.sum() + 0.6))
    bias, w = np.array([-2.0]), np.clip(prior, 0, None) * 0.5
    v = rng.normal(0, 0.01, (len(buckets), FACTORS))
    ones, zeros = np.flatnonzero(y == 1), np.flatnonzero(y == 0)

    def gradient(_: int) -> list[np.ndarray]:
        batch = np.concatenate([rng.choice(ones, 96), rng.choice(zeros, 160)])
        rows = np.repeat(np.arange(len(batch)), [len(found[i]) for i in batch])
        at = np.concatenate([found[i] for i in batch]) if len(rows) else np.zeros(0, np.int64)
        fm = FactorizationMachine(bias[0], buckets, w, v)
        error = (sigmoid(fm.margin(rows, at, len(batch))) - y[batch]) / len(batch)
        total = np.zeros((len(batch), FACTORS))
        np.add.at(total, rows, v[at])
        gw = np.bincount(at, error[rows], len(buckets)) + 1e-4 * w
        gv = np.zeros_like(v)
        np.add.at(gv, at, error[rows, None] * (total[rows] - v[at]))
        return [np.array([error.sum()]), gw, gv + 1e-3 * v]

    adam([bias, w, v], steps, 0.02, gradient)
    return FactorizationMachine(float(bias[0]), buckets, w, v)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> FactorizationMachine:
    """Learn from ``labels.toxic`` of at most ``rows`` documents outside the fold crc32(doc_id) mod 3 = 1."""
    prepared(docs.sparkSession)

    def ids(batches):
        memo: dict = {}
        for batch in batches:
            found = [text_ids(t, memo) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["ids", "label"])

    sample = labelled_sample(docs, labels, "toxic", 3, 1, rows).mapInArrow(ids, "ids array<int>, label int").toArrow()
    flat = sample.column("ids").combine_chunks()
    flat = flat if isinstance(flat, pa.ListArray) else pa.concat_arrays(flat.chunks) if flat.num_chunks else pa.array([], pa.list_(pa.int32()))
    at, values = flat.offsets.to_numpy(), flat.values.to_numpy()
    y = np.asarray(sample.column("label").to_numpy(), np.int64)
    order = np.argsort([zlib.crc32(values[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)], kind="stable")
    texts = [np.sort(values[at[i] : at[i + 1]]) for i in order]
    return fit_machine(texts, y[order] if len(y) else y)


def score_texts(docs: DataFrame, machine: FactorizationMachine, columns: list[str]) -> DataFrame:
    """``columns`` and ``score`` for every row of ``docs``."""
    kept_buckets = {int(b): i for i, b in enumerate(machine.buckets)}

    def run(batches):
        memo: dict = {}
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            rows, at = [], []
            for i, text in enumerate(texts):
                found: set[int] = set()
                for token in set((text.as_py() or "").split()):
                    hit = memo.get(token)
                    if hit is None:
                        if len(memo) >= 400_000:
                            memo.clear()
                        hit = memo[token] = tuple(kept_buckets[t] for t in term_ids(token) if t in kept_buckets)
                    if hit:
                        found.update(hit)
                rows.extend([i] * len(found))
                at.extend(found)
            margin = machine.margin(np.asarray(rows, np.int64), np.asarray(at, np.int64), batch.num_rows)
            yield batch, {"score": sigmoid(margin) if machine.trained else np.zeros(batch.num_rows)}

    return scored(docs, run, "score double", columns)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    out = score_texts(docs, fit(docs, labels), ["doc_id"])
    return out.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
