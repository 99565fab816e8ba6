"""Quality rules: document statistics judged by gradient-boosted trees with monotonic constraints.

Statistics of every whole text come from vectorised passes over its bytes. Trees are grown in numpy on histograms of a
bounded labelled sample; on constrained features a split is only taken if its two leaf values keep the demanded order,
and the values below it are bounded by their middle, so the score can never rise with, say, the share of symbols. The
fitted trees are flattened into node arrays: a row walks all trees at once by index arithmetic.

Defined cases: a null text has no words; a text without words fails the base rule; with no labels of either class the
method's verdict is to keep; repeated rows give repeated results; other columns are ignored.
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

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: name and demanded direction of the score: -1 never rises with the feature, 0 free.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "capital_share": -1,
    "digit_share": 0, "punct_share": 0, "bang_share": -1, "pipe_share": -1, "line_words": 0,
}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LEAD = bw.SPACES.astype(bool)  # first bytes of characters that are no space
_LEAD[128:192] = False  # continuation bytes of UTF-8
_KINDS = {"capital": range(65, 91), "digit": range(48, 58), "letter": [*range(65, 91), *range(97, 123)], "bang": [33], "pipe": [124], "punct": [33, 34, 39, 40, 41, 44, 46, 58, 59, 63]}
WINDOW = 8


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    if len(at) == 2:  # one text, maybe a very long one
        return np.array([np.count_nonzero(flags)])
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _repeats(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each (owner, hash) occurs twice or more."""
    code = bw.mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def statistics(block: bw.Block) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the five base counts, and the features in the order of FEATURES."""
    n = len(block.at) - 1
    starts, ends, first = bw.words(block, bw.SPACES)
    n_words = np.diff(first)
    data = block.data
    word_chars = _sums(_LEAD[data], block.at)
    hashes = bw.hash_spans(data, starts, ends)
    owner = np.repeat(np.arange(n), n_words)
    windows = bw.window_hash(hashes, WINDOW)
    at = bw.ranges(first[:-1], first[1:] - WINDOW + 1)
    repeated = at[_repeats(windows[at], owner[at])] if len(at) else at
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + WINDOW, -1)
    n_repeat = _sums(np.cumsum(cover)[:-1] > 0, first)
    # lines: spans between line feeds and text ends; those with a word count
    feeds = np.flatnonzero(data == 10)
    counts = np.bincount(np.searchsorted(block.at[1:], feeds, "right"), minlength=n) + 1
    last = np.cumsum(counts) - 1
    at_end = np.zeros(int(counts.sum()), bool)
    at_end[last] = True
    ends_of = np.empty(len(at_end), np.int64)
    ends_of[at_end], ends_of[~at_end] = block.at[1:], feeds
    line_start = np.zeros(len(at_end), np.int64)
    line_start[1:] = ends_of[:-1] + ~at_end[:-1]
    line_text = np.repeat(np.arange(n), counts)
    worded = np.searchsorted(starts, ends_of, "left") > np.searchsorted(starts, line_start, "left")
    lines = bw.hash_spans(data, line_start[worded], ends_of[worded])
    text_of = line_text[worded]
    code = bw.mix(lines + text_of.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    _, first_seen = np.unique(code, return_index=True)
    again = np.ones(len(code), bool)
    again[first_seen] = False
    n_lines, n_dup = np.bincount(text_of, minlength=n), np.bincount(text_of[again], minlength=n)
    n_symbols = _sums(_SYMBOL[data], block.at)
    base = np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], 1)
    kinds = {}
    for name, codes in _KINDS.items():
        flag = np.zeros(256, bool)
        flag[list(codes)] = True
        kinds[name] = _sums(flag[data], block.at)
    size, w, lines_n = np.maximum(word_chars, 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
    features = np.stack([
        np.log1p(n_words), word_chars / w, n_symbols / size, n_dup / lines_n, n_repeat / w,
        kinds["capital"] / np.maximum(kinds["letter"], 1), kinds["digit"] / size, kinds["punct"] / size, kinds["bang"] / size, kinds["pipe"] / size,
        np.log1p(n_words / lines_n),
    ], 1)
    return base, features


@dataclass(frozen=True)
class BoostParams:
    trees: int = 40
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    least: int = 10  # training rows in a leaf
    l2: float = 1.0
    sample: int = 8000  # most labelled texts that training uses
    threshold: float = 0.3


@dataclass
class Trees:
    """All trees' nodes in flat arrays; a leaf points to itself."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots) or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.bias)))
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.split[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.bias + self.value[node].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, p: BoostParams = BoostParams(), signs: tuple[int, ...] = tuple(FEATURES.values())) -> Trees:
    """Newton boosting of log loss over quantile histograms."""
    nodes: list[list[float]] = []
    roots: list[int] = []
    if not len(y) or y.min() == y.max():
        none = np.zeros(0)
        return Trees(none, none, none, none, none, np.zeros(0, np.int64), 0, 30.0 if not len(y) or y.max() else -30.0)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, p.bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    rate = float(y.mean())
    bias = np.log(rate / (1 - rate))
    total = np.full(len(y), bias)

    def grow(rows, g, h, depth, low, high):
        gs, hs = g[rows].sum(), h[rows].sum()
        own = float(np.clip(-gs / (hs + p.l2), low, high))
        best = (1e-6, None)
        if depth < p.depth and len(rows) >= 2 * p.least:
            for j, cut in enumerate(cuts):
                if not len(cut):
                    continue
                b = binned[rows, j]
                gl, hl, nl = (np.cumsum(np.bincount(b, v, len(cut) + 1))[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
                vl = np.clip(-gl / (hl + p.l2), low, high)
                vr = np.clip(-(gs - gl) / (hs - hl + p.l2), low, high)
                gain = gl**2 / (hl + p.l2) + (gs - gl) ** 2 / (hs - hl + p.l2) - gs**2 / (hs + p.l2)
                allowed = (nl >= p.least) & (len(rows) - nl >= p.least) & (signs[j] * (vr - vl) >= 0)
                gain = np.where(allowed, gain, -1)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, float(vl[k]), float(vr[k])))
        me = len(nodes)
        nodes.append([0, 0.0, me, me, p.rate * own])
        if best[1]:
            j, k, vl, vr = best[1]
            mid = (vl + vr) / 2
            left_bounds, right_bounds = (low, high), (low, high)
            if signs[j] < 0:
                left_bounds, right_bounds = (mid, high), (low, mid)
            elif signs[j] > 0:
                left_bounds, right_bounds = (low, mid), (mid, high)
            goes = binned[rows, j] <= k
            a = grow(rows[goes], g, h, depth + 1, *left_bounds)
            b = grow(rows[~goes], g, h, depth + 1, *right_bounds)
            nodes[me][:4] = [j, float(cuts[j][k]), a, b]
        return me

    for _ in range(p.trees):
        prob = 1 / (1 + np.exp(-total))
        root = grow(np.arange(len(y)), prob - y, prob * (1 - prob), 0, -8.0, 8.0)
        roots.append(root)
        flat = np.array(nodes)
        one = Trees(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int), flat[:, 4], np.array([root]), p.depth, 0.0)
        score = one.score(x)
        total += np.log(score / (1 - score))
    flat = np.array(nodes)
    return Trees(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int), flat[:, 4], np.array(roots), p.depth, float(bias))


def document_statistics(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, five base counts, features array) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, features = _batch(arrays(batch, "text"))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(features) + 1) * len(FEATURES), pa.int32()), pa.array(features.ravel()))
            yield pa.record_batch([arrays(batch, "doc_id"), *(pa.array(base[:, j]) for j in range(5)), flat], ["doc_id", *BASE, "features"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in BASE) + ", features array<double>")


def _batch(column) -> tuple[np.ndarray, np.ndarray]:
    found = [statistics(b) for b in bw.blocks(column)]
    if not found:
        return np.zeros((0, 5), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def train(docs: DataFrame, labels: DataFrame, p: BoostParams = BoostParams()) -> Trees:
    chosen = sample_of(labels.select("doc_id", F.col("quality").alias("_y")).where(F.col("_y").isin(0, 1) & F.col("doc_id").isNotNull()), "doc_id", p.sample)
    rows = document_statistics(docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")).join(F.broadcast(chosen), "doc_id")
    got = rows.select("doc_id", "features", "_y").orderBy("doc_id", "_y").limit(p.sample).toArrow()
    x = np.array(got.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, got.column("_y").to_numpy().astype(float), p)


def judged(docs: DataFrame, trees: Trees, p: BoostParams = BoostParams()) -> DataFrame:
    """Rows (doc_id, base counts, base_failed, score, kept) for every document."""
    held = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, features = _batch(arrays(batch, "text"))
            failed = (base[:, 0] < 20) | (100 * base[:, 4] > 30 * base[:, 0])
            score = held.value.score(features)
            yield pa.record_batch(
                [arrays(batch, "doc_id"), *(pa.array(base[:, j]) for j in range(5)), pa.array(failed), pa.array(~failed & (score >= p.threshold)), pa.array(score)],
                ["doc_id", *BASE, "base_failed", "kept", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in BASE) + ", base_failed boolean, kept boolean, score double")


def quality_rules(docs: DataFrame, labels: DataFrame, params: BoostParams = BoostParams()) -> DataFrame:
    return judged(docs, train(docs, labels, params), params)
