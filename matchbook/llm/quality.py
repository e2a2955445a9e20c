"""Quality: attention-based multiple-instance learning over the passages of a document.

A passage is ``PASSAGE`` consecutive words (ASCII white space separates words). It is encoded by the
shares of byte classes in it, the shares of repeated and distinct words, the length of its words and of
itself, then one dense layer. A gated attention ``softmax(w . (tanh(V h) * sigmoid(U h)))`` weighs a
document's passages, and a logistic layer scores the weighted mean. All weights are learnt together from
document labels, in NumPy, by back-propagation.

Training takes at most ``TRAIN_ROWS`` labelled documents (whole texts); scoring is one scan over every
whole text. Defined results: a null, empty or blank text is one passage of zeros; without labels every
score is 0, with labels of one kind near that kind; repeated rows score alike. Extra columns of any name
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import PhraseHasher, fold, prepared, text_blocks
from matchbook.llm.scoring import adam, labelled_sample, scored, sigmoid

PASSAGE = 96
TRAIN_ROWS = 6000
HIDDEN, ATTENTION = 16, 8
THRESHOLD = 0.7
#: Byte classes; every byte not named is in the last class.
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b".",
    b",", b"!", b"?", b":;", b"|", b"#", b"$", b"%", b"&", b"*", b"\"'`", b"()[]{}<>", b"-_", b"/\\", b"@+=~^",
    bytes(range(0xC0, 0x100)), bytes(range(0x80, 0xC0)),
)
N_CLASSES = len(CLASSES) + 1
N_FEATURES = N_CLASSES + 6


def byte_classes() -> np.ndarray:
    out = np.full(256, len(CLASSES), np.int64)
    for i, members in enumerate(CLASSES):
        out[list(members)] = i
    return out


def passages(data: np.ndarray, offsets: np.ndarray, hasher: PhraseHasher, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, first passage of each text); a text without words is one row of zeros."""
    n = len(offsets) - 1
    words, first = hasher.words(data, offsets)
    per_text = np.diff(first)
    count = np.maximum(1, -(-per_text // PASSAGE))
    begin = np.concatenate([[0], np.cumsum(count)])
    total = int(begin[-1])
    of_word = np.repeat(begin[:-1] - first[:-1] * 0, per_text) + (np.arange(len(words)) - np.repeat(first[:-1], per_text)) // PASSAGE
    # a byte belongs to the passage of the last word that began at or before it (the first word's, before it)
    letter = hasher.letter[data]
    start = letter.copy()
    if len(data):
        start[1:] &= ~letter[:-1]
        inner = offsets[:-1][(np.diff(offsets) > 0)]
        start[inner] = letter[inner]
    seen = np.cumsum(start) - 1
    text_of = np.repeat(np.arange(n), np.diff(offsets))
    at = np.clip(np.maximum(seen, first[:-1][text_of]), 0, max(0, len(words) - 1))
    byte_passage = np.where(per_text[text_of] > 0, of_word[at] if len(words) else 0, begin[:-1][text_of])
    hist = np.bincount(byte_passage * N_CLASSES + classes[data], minlength=total * N_CLASSES).reshape(total, N_CLASSES)
    size = np.maximum(hist.sum(1), 1)
    n_words = np.bincount(of_word, minlength=total)
    same = np.zeros(len(words), bool)
    if len(words) > 1:
        same[1:] = (words[1:] == words[:-1]) & (of_word[1:] == of_word[:-1])
    key = np.sort(words ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(words ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    new = np.ones(len(words), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount(of_word[order[new]], minlength=total)
    least = np.maximum(n_words, 1)
    extra = np.stack(
        [
            np.bincount(of_word, same, total) / least,
            distinct / least,
            size / least / 10.0,
            np.log1p(n_words) / 5.0,
            hist[:, 4] / least,
            hist[:, 1] / np.maximum(hist[:, 0] + hist[:, 1], 1),
        ],
        1,
    )
    features = np.concatenate([np.sqrt(hist / size[:, None]), extra], 1)
    features[n_words == 0] = 0
    return features.astype(np.float32), begin


@dataclass
class PassageNet:
    encode: np.ndarray
    shift: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    trained: bool = True

    def forward(self, x: np.ndarray, begin: np.ndarray) -> dict:
        """begin: first passage of each text, and the end; every text has a passage."""
        h = np.tanh(x @ self.encode + self.shift)
        t, s = np.tanh(h @ self.v), sigmoid(h @ self.u)
        e = (t * s) @ self.w
        bag = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        e = np.exp(e - np.maximum.reduceat(e, begin[:-1])[bag])
        a = e / np.add.reduceat(e, begin[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, begin[:-1], axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "bag": bag, "y": sigmoid(z @ self.out + self.bias[0])}


def new_net(seed: int = 11) -> PassageNet:
    rng = np.random.default_rng(seed)
    return PassageNet(
        rng.normal(0, 0.4, (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.4, (HIDDEN, ATTENTION)),
        rng.normal(0, 0.4, (HIDDEN, ATTENTION)), rng.normal(0, 0.4, ATTENTION), rng.normal(0, 0.4, HIDDEN), np.zeros(1),
    )


def fit_net(x: list[np.ndarray], y: np.ndarray, steps: int = 1500, seed: int = 11) -> PassageNet:
    """Adam on the logistic loss, 128 documents at a time, half of each label."""
    net = new_net(seed)
    if not len(y):
        net.trained = False
        return net
    if y.min() == y.max():
        net.out[:], net.bias[0] = 0, 4.0 if y[0] else -4.0
        return net
    rng = np.random.default_rng(seed)
    sides = np.flatnonzero(y == 1), np.flatnonzero(y == 0)

    def gradient(_: int) -> list[np.ndarray]:
        pick = np.concatenate([rng.choice(side, 64) for side in sides])
        begin = np.concatenate([[0], np.cumsum([len(x[i]) for i in pick])])
        rows = np.concatenate([x[i] for i in pick])
        f = net.forward(rows, begin)
        h, t, s, a, bag = f["h"], f["t"], f["s"], f["a"], f["bag"]
        error = (f["y"] - y[pick]) / len(pick)
        dz = error[:, None] * net.out
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, begin[:-1])[bag])
        gate = de[:, None] * net.w
        dt, ds = gate * s * (1 - t * t), gate * t * s * (1 - s)
        dh = (a[:, None] * dz[bag] + dt @ net.v.T + ds @ net.u.T) * (1 - h * h)
        decay = 1e-4
        return [
            rows.T @ dh + decay * net.encode, dh.sum(0), h.T @ dt + decay * net.v, h.T @ ds + decay * net.u,
            (t * s).T @ de, f["z"].T @ error + decay * net.out, np.array([error.sum()]),
        ]

    adam([net.encode, net.shift, net.v, net.u, net.w, net.out, net.bias], steps, 0.01, gradient)
    return net


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> PassageNet:
    """Learn from ``labels.quality`` of at most ``rows`` documents outside the fold crc32(doc_id) mod 4 = 2."""
    prepared(docs.sparkSession)

    def encode(batches):
        hasher, classes = PhraseHasher(), byte_classes()
        for block, data, offsets in text_blocks(batches, "text", 1 << 20):
            x, begin = passages(data, offsets, hasher, classes)
            bags = [x[a:b].tobytes() for a, b in zip(begin, begin[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(bags, pa.binary()), block.column(1)], names=["bag", "label"])

    got = labelled_sample(docs, labels, "quality", 4, 2, rows).mapInArrow(encode, "bag binary, label int").toArrow()
    bags = sorted(zip(got.column("bag").to_pylist(), got.column("label").to_pylist(), strict=True))
    x = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b, _ in bags]
    return fit_net(x, np.asarray([label for _, label in bags], np.int64))


def score_texts(docs: DataFrame, net: PassageNet, columns: list[str]) -> DataFrame:
    """``columns`` and ``score`` for every row of ``docs``."""

    def run(batches):
        hasher, classes = PhraseHasher(), byte_classes()
        for block, data, offsets in text_blocks(batches, "__text", 1 << 20):
            x, begin = passages(data, offsets, hasher, classes)
            yield block, {"score": net.forward(x, begin)["y"] if net.trained else np.zeros(block.num_rows)}

    return scored(docs, run, "score double", columns)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    out = score_texts(docs, fit(docs, labels), ["doc_id"])
    return out.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
