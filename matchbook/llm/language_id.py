"""Language identification with a byte convolutional network, trained and applied in NumPy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last one padded with zero bytes). A
window goes through a byte embedding, filters of several widths, a rectified maximum over the positions
and a softmax; a text's score for a language is the mean over its windows, weighted by their bytes, so
every byte of the whole text counts.

Training takes documents with a language outside the held-out fold: all of them up to ``TRAIN_DOCS``; of more,
every language has its own share, ``TRAIN_DOCS`` divided by the number of languages but at least
``LANGUAGE_DOCS``. A language with fewer documents gives all of them; one with more gives a hash sample of about
nine tenths of its share, and its document of least hash always. Languages are counted over all training rows,
so the set of labels doesn't depend on the sample. Of a document ``TRAIN_WINDOWS`` windows are taken, spread
evenly over the text; in a sample, equal windows of rows with equal id and text are one. Applying is one scan without a
shuffle.
Defined results: a null text or one without a letter is ``und`` with score 0, as is every text if nothing
was learnt; with one learnt language every other text gets it; repeated rows are judged alike; equal
scores fall to the language first in text order. Extra columns of any name are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import fold, prepared, text_blocks
from matchbook.llm.scoring import adam, scored

WINDOW = 256
TRAIN_DOCS = 3000
#: Documents of each language at least, however many languages there are.
LANGUAGE_DOCS = 30
TRAIN_WINDOWS = 4
EMBED = 6
WIDTHS = (2, 3, 4)
FILTERS = 12
#: The pipeline's stage lets a document go below this score.
MIN_SCORE = 0.4
LETTER = re.compile(r"[^\W\d_]")


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window bytes as rows, text of each window, bytes in each window); an empty text has no window."""
    length = np.diff(offsets)
    count = -(-length // WINDOW)
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(int(first[-1]) * WINDOW, np.uint8)
    out[np.arange(len(data)) + np.repeat(first[:-1] * WINDOW - offsets[:-1], length)] = data
    text = np.repeat(np.arange(len(length)), count)
    left = np.repeat(length, count) - (np.arange(first[-1]) - first[:-1][text]) * WINDOW
    return out.reshape(-1, WINDOW), text, np.minimum(left, WINDOW)


@dataclass
class ByteNet:
    """Languages in text order; byte embedding; filters of every width (padded to the widest); dense layer."""

    languages: list[str]
    embed: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    dense: np.ndarray
    bias: np.ndarray

    def patches(self, rows: np.ndarray) -> np.ndarray:
        """Each position's next bytes, embedded: (windows, positions, widest * EMBED)."""
        wide = max(WIDTHS)
        padded = np.zeros((len(rows), WINDOW + wide - 1), np.uint8)
        padded[:, :WINDOW] = rows
        e = self.embed[padded].reshape(len(rows), -1)
        step = e.strides[1]
        view = np.lib.stride_tricks.as_strided(
            e, (len(rows), WINDOW, wide * EMBED), (e.strides[0], EMBED * step, step), writeable=False
        )
        return np.ascontiguousarray(view)

    def probabilities(self, rows: np.ndarray, at_once: int = 256) -> np.ndarray:
        out = np.empty((len(rows), len(self.languages)), np.float32)
        for i in range(0, len(rows), at_once):
            x = self.patches(rows[i : i + at_once])
            maps = x.reshape(-1, x.shape[2]) @ self.filters
            top = np.maximum(maps.reshape(len(x), WINDOW, -1).max(1) + self.shift, 0)
            z = top @ self.dense + self.bias
            z = np.exp(z - z.max(1, keepdims=True))
            out[i : i + at_once] = z / z.sum(1, keepdims=True)
        return out


def width_mask() -> np.ndarray:
    """1 where a filter of its width has a weight."""
    mask = np.zeros((max(WIDTHS) * EMBED, len(WIDTHS) * FILTERS), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * EMBED, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


def fit_net(rows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = 500, seed: int = 5) -> ByteNet:
    """Adam on the cross entropy, 64 windows at a time, every language alike."""
    rng = np.random.default_rng(seed)
    mask = width_mask()
    n = mask.shape[1]
    net = ByteNet(
        languages,
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32),
        np.zeros(n, np.float32),
        rng.normal(0, 0.2, (n, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    if len(languages) < 2:
        return net
    of = [np.flatnonzero(labels == i) for i in range(len(languages))]
    each = max(1, 64 // len(languages))
    wide = max(WIDTHS)

    def gradient(_: int) -> list[np.ndarray]:
        pick = np.concatenate([rng.choice(x, each) for x in of])
        block = rows[pick]
        x = net.patches(block)
        maps = (x.reshape(-1, x.shape[2]) @ net.filters).reshape(len(pick), WINDOW, n)
        best = maps.argmax(1)
        pre = np.take_along_axis(maps, best[:, None, :], 1)[:, 0] + net.shift
        top = np.maximum(pre, 0)
        z = top @ net.dense + net.bias
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        z[np.arange(len(pick)), labels[pick]] -= 1
        z /= len(pick)
        back = (z @ net.dense.T) * (pre > 0)
        seen = x[np.arange(len(pick))[:, None], best]
        g_filters = np.einsum("bf,bfk->kf", back, seen) * mask
        g_patch = (back[:, :, None] * net.filters.T[None]).reshape(len(pick), n, wide, EMBED)
        g_embed = np.zeros_like(net.embed)
        padded = np.zeros((len(pick), WINDOW + wide - 1), np.uint8)
        padded[:, :WINDOW] = block
        for j in range(wide):
            np.add.at(g_embed, padded[np.arange(len(pick))[:, None], best + j], g_patch[:, :, j])
        return [g_embed, g_filters, back.sum(0), top.T @ z, z.sum(0)]

    adam([net.embed, net.filters, net.shift, net.dense, net.bias], steps, 0.01, gradient)
    return net


def training_rows(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[DataFrame, bool]:
    """text, lang, key of the training documents, and whether they are a sample: with more than ``train_docs`` of
    them, each language gives about 0.9 of its share at most, and one document at least."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", 3) != 1))
    known = known.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), "doc_id")
    known = known.select("text", "lang", F.xxhash64("doc_id", "text").alias("key"))
    place = F.pmod("key", F.lit(1 << 30))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")).collect()
    if sum(r.n for r in sizes) <= train_docs:
        return known, False
    share = max(LANGUAGE_DOCS, train_docs // len(sizes))
    cuts = {r.lang: max(int(0.9 * share / r.n * (1 << 30)), r.least + 1) for r in sizes if r.n > share}
    if not cuts:
        return known, True
    bounds = F.create_map(*[F.lit(x) for pair in sorted(cuts.items()) for x in pair])
    return known.filter(place < F.coalesce(bounds[F.col("lang")], F.lit(1 << 30))), True


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> ByteNet:
    """Learn from text and language of bounded documents of every language outside the fold crc32(doc_id) mod 3 = 1."""
    prepared(docs.sparkSession)
    sample, _ = training_rows(docs, train_docs)

    def cut(batches):
        for block, data, offsets in text_blocks(batches, "text", 1 << 20):
            rows, text, _ = windows(data, offsets)
            first = np.searchsorted(text, np.arange(block.num_rows + 1))
            pick = [
                i
                for a, b in zip(first, first[1:], strict=False)
                for i in np.unique(np.linspace(a, b - 1, TRAIN_WINDOWS).astype(int))
                if b > a
            ]
            pick = np.asarray(pick, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in rows[pick]], pa.binary()), *(block.column(i).take(pa.array(text[pick])) for i in (1, 2))],
                names=["window", "lang", "key"],
            )

    cuts = sample.mapInArrow(cut, "window binary, lang string, key bigint")
    got = cuts.distinct().select("window", "lang").toArrow()
    lang = got.column("lang").to_pylist()
    raw = got.column("window").to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (raw[i], lang[i]))
    languages = sorted(set(lang))
    rows = np.frombuffer(b"".join(raw[i] for i in order), np.uint8).reshape(-1, WINDOW)
    code = {x: i for i, x in enumerate(languages)}
    return fit_net(rows, np.asarray([code[lang[i]] for i in order], np.int64), languages)


def predicted(docs: DataFrame, net: ByteNet, columns: list[str]) -> DataFrame:
    """``columns``, ``lang_pred`` and ``score`` for every row of ``docs``."""

    def run(batches):
        for block, data, offsets in text_blocks(batches, "__text", 1 << 20):
            n = block.num_rows
            texts = block.column(block.num_columns - 1)
            letters = np.array([bool(t) and LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            mean = np.zeros((n, max(1, len(net.languages))))
            if net.languages and len(data):
                rows, text, size = windows(data, offsets)
                np.add.at(mean, text, net.probabilities(rows) * size[:, None])
                mean /= np.maximum(mean.sum(1, keepdims=True), 1e-9)
            best = mean.argmax(1)
            known = letters & bool(net.languages)
            names = np.array([*net.languages, "und"], object)
            yield block, {
                "lang_pred": pa.array(names[np.where(known, best, len(net.languages))].tolist(), pa.string()),
                "score": np.where(known, np.clip(mean[np.arange(n), best], 0, 1), 0.0),
            }

    return scored(docs, run, "lang_pred string, score double", columns)


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    out = predicted(docs, fit(docs), ["doc_id"])
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is known with ``min_score`` at least, with their own columns. Where no document
    outside the held-out fold has a language nothing can be learnt, every language is unknown and no document stays."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    out = predicted(docs.select(row, "text"), fit(docs), ["row"])
    return out.filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select("row.*")
