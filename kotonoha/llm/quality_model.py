"""Quality classifier: hashed word n-grams, logistic regression with follow-the-regularised-leader updates.

A text's features are its single words, pairs of neighbouring words, runs of symbols, a marker for a word wholly in capitals
and one for a word said twice in a row, all hashed into ``2**bits`` weights; each counts by its share of the text. Training (one task, numpy) walks over
a bounded sample of labelled texts with per-coordinate FTRL-Proximal steps. Scoring is one sparse dot product per text.

Defined cases: a null text is an empty one; an empty text has only the bias; labels other than 0 and 1 and texts over
``longest`` bytes are left out of training only; with no usable labels every score is 0.5. Input columns besides the id
and the text are ignored, repeated rows give repeated results, and labels repeated for one id count each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import arrays, sample_of


@dataclass(frozen=True)
class FtrlParams:
    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4
    epochs: int = 4
    scale: float = 12.0
    sample: int = 3000  # most labelled texts that training uses
    longest: int = 30_000  # most bytes of a text that training uses
    threshold: float = 0.3


_CAPS, _TWICE, _PAIR = np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x3C3C3C3C3C3C3C3C), np.uint64(0xD6E8FEB86659FD93)


def features(block: bw.Block, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all features, text after text, and the bounds of the texts."""
    starts, ends, first = bw.words(block, bw.ALNUM)
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(block.at), np.int64)
    low = bw.LOWER[block.data]
    hashes = bw.hash_spans(low, starts, ends)
    capital = np.zeros(len(low) + 1, np.int64)
    np.cumsum(low != block.data, out=capital[1:])
    caps = (capital[ends] - capital[starts] == ends - starts) & (ends - starts > 1)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pair = bw.mix(hashes[:-1] * _PAIR + hashes[1:])
    same = owner[1:] == owner[:-1]
    twice = same & (hashes[1:] == hashes[:-1])
    texts = np.concatenate([owner, owner[:-1][same], owner[caps], owner[:-1][twice]])
    slots = np.concatenate([hashes, pair[same], np.full(int(caps.sum()), _CAPS), np.full(int(twice.sum()), _TWICE)]) >> np.uint64(64 - bits)
    order = np.argsort(texts, kind="stable")
    return slots[order].astype(np.int64), np.searchsorted(texts[order], np.arange(len(first)))


@dataclass
class FtrlModel:
    """Weights of the hashed features and the bias."""

    params: FtrlParams
    weights: np.ndarray
    bias: float = 0.0

    def score(self, column) -> np.ndarray:
        out = np.empty(len(column))
        for block in bw.blocks(column):
            slots, at = features(block, self.params.bits)
            total = np.zeros(len(slots) + 1)
            np.cumsum(self.weights[slots], out=total[1:])
            mean = (total[at[1:]] - total[at[:-1]]) / np.maximum(at[1:] - at[:-1], 1)
            out[block.lo : block.hi] = 1 / (1 + np.exp(-np.clip(self.bias + self.params.scale * mean, -30, 30)))
        return out


def fit(texts: list[str], labels: np.ndarray, params: FtrlParams = FtrlParams()) -> FtrlModel:
    size = 1 << params.bits
    z, n = np.zeros(size), np.zeros(size)
    bz = bn = 0.0
    model = FtrlModel(params, np.zeros(size, np.float64))
    if not len(texts):
        return model
    rows = []
    for block in bw.blocks(pa.array(texts, pa.large_string())):
        slots, at = features(block, params.bits)
        for i in range(len(at) - 1):
            own, counts = np.unique(slots[at[i] : at[i + 1]], return_counts=True)
            rows.append((own.astype(np.int32), (params.scale * counts / max(1, counts.sum())).astype(np.float32)))
    rng = np.random.default_rng(7)

    def weight(zi, ni):
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - params.l1, 0)
        return -shrunk / ((params.beta + np.sqrt(ni)) / params.alpha + params.l2)

    for _ in range(params.epochs):
        for i in rng.permutation(len(rows)):
            own, x = rows[i]
            w, b = weight(z[own], n[own]), -bz / ((params.beta + np.sqrt(bn)) / params.alpha)
            g = 1 / (1 + np.exp(-np.clip(w @ x + b, -30, 30))) - labels[i]
            gx = g * x
            grown = n[own] + gx * gx
            z[own] += gx - (np.sqrt(grown) - np.sqrt(n[own])) / params.alpha * w
            n[own] = grown
            more = bn + g * g
            bz += g - (np.sqrt(more) - np.sqrt(bn)) / params.alpha * b
            bn = more
    model.weights = weight(z, n)
    model.bias = float(-bz / ((params.beta + np.sqrt(bn)) / params.alpha))
    return model


def train(docs: DataFrame, labels: DataFrame, label: str, held_out, params: FtrlParams = FtrlParams()) -> FtrlModel:
    """Fits on the bounded sample of labelled rows for which ``held_out`` (a Column over doc_id) is false.

    One task fits; the driver gets the weights alone, never the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y = [], []
        for batch in batches:
            texts += arrays(batch, "text").to_pylist()
            y += arrays(batch, "_label").to_pylist()
        model = fit(texts, np.array(y, float), params)
        yield pa.record_batch([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    got = labelled(docs, labels, label, held_out, params.sample, params.longest).mapInArrow(run, "weights binary, bias double").toArrow()
    if not got.num_rows:
        return fit([], np.zeros(0), params)
    return FtrlModel(params, np.frombuffer(got.column("weights")[0].as_py()), got.column("bias")[0].as_py())


def labelled(docs: DataFrame, labels: DataFrame, label: str, held_out, sample: int, longest: int) -> DataFrame:
    """Rows (doc_id, text, _label), in order, of at most ``sample`` labelled documents of at most ``longest`` bytes."""
    chosen = sample_of(
        labels.select("doc_id", F.col(label).alias("_label")).where(F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out),
        "doc_id", sample,
    )
    return (
        docs.select("doc_id", "text").where(F.octet_length("text") <= longest)
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "text", "_label").orderBy("doc_id", "text", "_label").limit(sample)
    )


def scored(docs: DataFrame, model, *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, score): one for each document, its whole text scored by ``model``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([arrays(batch, "doc_id"), pa.array(held.value.score(arrays(batch, "text")))], ["doc_id", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def held_out(remainder: int, modulus: int):
    """Whether crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, params: FtrlParams = FtrlParams()) -> DataFrame:
    """Columns doc_id, held_out, score (1 is good), predicted, for every document."""
    model = train(docs, labels, "quality", held_out(0, 5), params)
    return verdicts(scored(docs, model), held_out(0, 5), params.threshold)


def verdicts(scores: DataFrame, out, threshold: float) -> DataFrame:
    return scores.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, params: FtrlParams = FtrlParams()) -> DataFrame:
    """The documents that the classifier does not reject, all columns as they were."""
    model = train(docs, labels, "quality", held_out(0, 5), params)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held.value.score(arrays(batch, "text")) >= params.threshold))

    return docs.mapInArrow(run, docs.schema)
