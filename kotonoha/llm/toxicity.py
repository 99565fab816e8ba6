"""Toxicity: bags of subword embeddings averaged into a linear softmax, trained jointly in numpy.

A word's bag holds the word itself and its character n-grams (3 to 5 bytes, with marks at both ends), hashed into
``2**bits`` rows of an embedding matrix, so an unseen misspelling shares most rows with the word it distorts. The
embeddings of a bag are averaged to a word vector, those of a window of neighbouring words averaged again and put through a softmax of two classes; a text counts as
toxic as its most toxic window, so that one insult in a long text is not averaged away. Embeddings and softmax are
trained together by gradient steps (Adagrad) over some texts at a time: positive texts pull at their most toxic window,
negative texts at their most toxic ones and some at random; positive texts that still look clean after two rounds are taken for mislabelled. For scoring, softmax times embedding is folded into one number a row; an average of
embeddings then is an average of these numbers. Distinct words of a block are hashed into n-grams once.

Defined cases: a null text is an empty one; a text without words has the score of an empty bag (the bias); words longer
than 40 bytes have their n-grams like others; labels other than 0 and 1 are left out of training; with no labels every
score is 0.5. Repeated rows give repeated results; input columns besides id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytewords as bw
from .quality_model import held_out, scored, labelled, verdicts


@dataclass(frozen=True)
class ToxicityParams:
    bits: int = 20
    min_docs: int = 4  # rows that fewer training texts have stay zero: they could only be learnt by heart
    dim: int = 8
    shortest: int = 3
    widest: int = 5
    window: int = 5
    epochs: int = 6
    hard: int = 5  # windows of a negative text that each round corrects
    trust: float = 0.2  # in the last round positive texts that score lower count as mislabelled, before in proportion
    rate: float = 1.0
    batch: int = 16  # texts of a gradient step
    gain: float = 24.0
    balance: float = 4.0  # most weight of a positive text against a negative one
    sample: int = 6000  # most labelled texts that training uses
    longest: int = 20_000  # most bytes of a text that training uses
    threshold: float = 0.3


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: ToxicityParams) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all words' bags, word after word, and the bounds of the bags."""
    sizes = ends - starts + 2
    at = np.concatenate(([0], np.cumsum(sizes)))
    marked = np.full(int(at[-1]), 60, np.uint8)
    marked[at[1:] - 1] = 62
    inner = bw.ranges(at[:-1] + 1, at[1:] - 1)
    marked[inner] = data[bw.ranges(starts, ends)]
    prefix = bw.prefix_hash(marked)
    grams, owner = [bw.span_hash(prefix, at[:-1], at[1:])], [np.arange(len(starts))]
    for width in range(p.shortest, p.widest + 1):
        counts = np.maximum(sizes - width + 1, 0)
        first = bw.ranges(at[:-1], at[:-1] + counts)
        grams.append(bw.span_hash(prefix, first, first + width))
        owner.append(np.repeat(np.arange(len(starts)), counts))
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    rows = (np.concatenate(grams) >> np.uint64(64 - p.bits)).astype(np.int64)[order]
    return rows, np.searchsorted(owner[order], np.arange(len(starts) + 1))


def windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (in words) of half-overlapping windows, and the first window of each text; a text has one at least."""
    counts = np.diff(first)
    step = max(1, width // 2)
    n = np.maximum(1, -(-np.maximum(counts - width, 0) // step) + 1)
    at = np.concatenate(([0], np.cumsum(n)))
    number = np.arange(at[-1]) - np.repeat(at[:-1], n)
    base, top = np.repeat(first[:-1], n), np.repeat(first[1:], n)
    lo = base + number * step
    return lo, np.minimum(lo + width, top), at


@dataclass
class ToxicityModel:
    """``rows`` holds gain * softmax weight . embedding for each bucket, toxic minus clean."""

    params: ToxicityParams
    rows: np.ndarray
    bias: float = 0.0

    def bag_means(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Average over each word's bag, some words at a time; a word beyond ``bw.PIECE`` bytes goes piece by piece."""
        out, upto, i = np.empty(len(starts)), np.concatenate(([0], np.cumsum(ends - starts))), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + bw.PIECE, "right")) - 1)
            if upto[j] - upto[i] > bw.PIECE:
                out[i] = self._long_mean(data[starts[i] : ends[i]])
            else:
                bags, at = subwords(data, starts[i:j], ends[i:j], self.params)
                total = np.concatenate(([0.0], np.cumsum(self.rows[bags], dtype=np.float64)))
                out[i:j] = (total[at[1:]] - total[at[:-1]]) / np.diff(at)
            i = j
        return out

    def _long_mean(self, word: np.ndarray) -> float:
        p, marked = self.params, np.concatenate(([60], word, [62])).astype(np.uint8)
        shift = np.uint64(64 - p.bits)
        total, n = float(self.rows[int(bw.hash_spans(marked, np.array([0]), np.array([len(marked)]))[0] >> shift)]), 1
        for at in range(0, len(marked), bw.PIECE):
            piece = marked[at : at + bw.PIECE + p.widest - 1]
            prefix = bw.prefix_hash(piece)
            for width in range(p.shortest, p.widest + 1):
                first = np.arange(max(0, min(bw.PIECE, len(piece) - width + 1)))
                total += float(self.rows[(bw.span_hash(prefix, first, first + width) >> shift).astype(np.int64)].sum(dtype=np.float64))
                n += len(first)
        return total / n

    def score(self, column) -> np.ndarray:
        out = np.empty(len(column))
        p = self.params
        for block in bw.blocks(column):
            starts, ends, first = bw.words(block, bw.ALNUM)
            low = bw.LOWER[block.data]
            sums = np.zeros(len(starts) + 1)
            if len(starts):
                _, chosen, code = np.unique(bw.hash_spans(low, starts, ends), return_index=True, return_inverse=True)
                np.cumsum(self.bag_means(low, starts[chosen], ends[chosen])[code], out=sums[1:])
            lo, hi, begin = windows(first, p.window)
            mean = (sums[hi] - sums[lo]) / np.maximum(hi - lo, 1)
            worst = np.maximum.reduceat(mean, begin[:-1])
            out[block.lo : block.hi] = 1 / (1 + np.exp(-np.clip(self.bias + worst, -30, 30)))
        return out


def _picked(text: np.ndarray, mean: np.ndarray, labels: np.ndarray, rng, p: ToxicityParams, first_round: bool) -> np.ndarray:
    """Windows that a round corrects: a positive text's worst one (all in the first round, when it is not known yet where the
    insult stands), a negative text's ``hard`` worst ones and two at random."""
    order = np.argsort(text + 0.999 / (1 + np.exp(np.clip(p.gain * mean, -30, 30))))  # by text, worst windows first
    start = np.searchsorted(text, np.arange(len(labels) + 1))
    rank = np.arange(len(order)) - start[text[order]]
    bad = labels[text[order]] == 1
    picks = order[np.where(bad, first_round | (rank == 0), rank < p.hard)]
    clean = np.flatnonzero((labels != 1) & (np.diff(start) > 0))
    more = np.concatenate([start[clean] + (rng.random(len(clean)) * (start[clean + 1] - start[clean])).astype(np.int64) for _ in range(2)])
    return np.unique(np.concatenate([picks, more]))


def fit(texts: list[str], labels: np.ndarray, p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    size = 1 << p.bits
    if not len(texts):
        return ToxicityModel(p, np.zeros(size))
    vocabulary: dict[int, int] = {}
    bags: list[np.ndarray] = []
    docs: list[np.ndarray] = []
    for block in bw.blocks(pa.array(texts, pa.large_string())):
        starts, ends, first = bw.words(block, bw.ALNUM)
        low = bw.LOWER[block.data]
        hashes = bw.hash_spans(low, starts, ends)
        known, chosen, code = np.unique(hashes, return_index=True, return_inverse=True)
        rows, at = subwords(low, starts[chosen], ends[chosen], p) if len(starts) else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        ids = np.zeros(len(known), np.int64)
        for i, h in enumerate(known.tolist()):
            if h not in vocabulary:
                vocabulary[h] = len(bags)
                bags.append(rows[at[i] : at[i + 1]])
            ids[i] = vocabulary[h]
        ids = ids[code] if len(ids) else ids
        docs += [ids[first[i] : first[i + 1]] for i in range(len(first) - 1)]
    flat = np.concatenate([*bags, np.zeros(0, np.int64)]).astype(np.int32)
    bounds = np.concatenate(([0], np.cumsum([len(b) for b in bags]))).astype(np.int64)
    size_of = np.maximum(np.diff(bounds), 1)
    seen = np.zeros(size, np.int64)
    for own in docs:
        words_of = np.unique(own)
        seen[np.unique(flat[bw.ranges(bounds[words_of], bounds[words_of + 1])])] += 1
    live = (seen >= p.min_docs)[:, None]
    rng = np.random.default_rng(11)
    emb = rng.normal(0, 0.1, (size, p.dim)).astype(np.float32) * live
    soft = rng.normal(0, 0.1, (2, p.dim))
    bias = np.zeros(2)
    heat, heat_soft = np.full(size, 1e-8), 1e-8
    positive = max(1.0, float((labels == 1).sum()))
    weight = np.where(labels == 1, min(p.balance, max(1.0, (len(labels) - positive) / positive)), 1.0)
    # All windows of all texts, once; texts without words have none.
    counts = np.array([len(d) for d in docs], np.int64)
    own = np.concatenate([*docs, np.zeros(0, np.int64)]).astype(np.int32)
    docs = bags = vocabulary = None  # the flat forms stand for them from here on
    lo, hi, begin = windows(np.concatenate(([0], np.cumsum(counts))), p.window)
    text = np.repeat(np.arange(len(counts), dtype=np.int32), np.diff(begin))
    real = hi > lo
    lo, hi, text = lo[real].astype(np.int32), hi[real].astype(np.int32), text[real]
    for epoch in range(p.epochs):
        trust = max(1e-3, p.trust * epoch / max(1, p.epochs - 1))
        total = np.concatenate(([0.0], np.cumsum((emb @ (soft[1] - soft[0]))[flat])))
        word_mean = (total[bounds[1:]] - total[bounds[:-1]]) / size_of
        s = np.concatenate(([0.0], np.cumsum(word_mean[own])))
        mean = (s[hi] - s[lo]) / (hi - lo)
        picks = _picked(text, mean, labels, rng, p, epoch == 0)
        if epoch >= 2:
            doubtful = np.zeros(len(counts), bool)
            np.maximum.at(worst := np.full(len(counts), -np.inf), text, mean)
            doubtful[(labels == 1) & (p.gain * worst + bias[1] - bias[0] < np.log(trust / (1 - trust)))] = True
            picks = picks[~doubtful[text[picks]]]
        # Texts in random order, some at a time.
        place = rng.permutation(len(counts))[text[picks]] // p.batch
        order = np.argsort(place, kind="stable")
        picks, cuts = picks[order], np.searchsorted(place[order], np.arange(len(counts) // p.batch + 2))
        for k in range(len(cuts) - 1):
            mine = picks[cuts[k] : cuts[k + 1]]
            if not len(mine):
                continue
            # The distinct words of the batch, their vectors, and each window's average of these.
            lengths = hi[mine] - lo[mine]
            words_here, code = np.unique(own[bw.ranges(lo[mine], hi[mine])], return_inverse=True)
            sizes = size_of[words_here]
            rows = flat[bw.ranges(bounds[words_here], bounds[words_here + 1])]
            vectors = np.add.reduceat(emb[rows], np.concatenate(([0], np.cumsum(sizes)[:-1]))) / sizes[:, None]
            at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            hidden = p.gain * np.add.reduceat(vectors[code], at) / lengths[:, None]
            logits = hidden @ soft.T + bias
            prob = np.exp(logits - logits.max(1, keepdims=True))
            prob /= prob.sum(1, keepdims=True)
            _, which, many = np.unique(text[mine], return_inverse=True, return_counts=True)
            g = prob
            g[np.arange(len(mine)), labels[text[mine]].astype(np.int64)] -= 1
            # A negative text's worst window weighs as much as its others together.
            clean = (labels[text[mine]] != 1) & (many[which] > 1)
            worst_here = np.full(len(many), -np.inf)
            np.maximum.at(worst_here, which, mean[mine])
            share = np.where(clean, np.where(mean[mine] >= worst_here[which], 1.0, 1.0 / np.maximum(many[which] - 1, 1)), 1.0 / many[which])
            g *= (weight[text[mine]] * share)[:, None]
            # Back to words, then to the rows of their bags.
            per_window = p.gain * (g @ soft) / lengths[:, None]
            by_word = np.stack([np.bincount(code, np.repeat(per_window[:, d], lengths), len(words_here)) for d in range(p.dim)], 1)
            step = np.repeat(by_word / sizes[:, None], sizes, 0)
            touched, spot = np.unique(rows, return_inverse=True)
            step = np.stack([np.bincount(spot, step[:, d], len(touched)) for d in range(p.dim)], 1) * live[touched]
            heat[touched] += (step * step).sum(1)
            emb[touched] -= p.rate * 0.2 * step / np.sqrt(heat[touched])[:, None]
            gs = g.T @ hidden
            heat_soft += float((gs * gs).sum())
            soft -= p.rate * 0.2 * gs / np.sqrt(heat_soft)
            bias -= 0.02 * g.sum(0)
    return ToxicityModel(p, (p.gain * (emb @ (soft[1] - soft[0]))).astype(np.float32), float(bias[1] - bias[0]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """Columns doc_id, held_out, score (1 is toxic), predicted, for every document."""
    found = labelled(docs, labels, "toxic", held_out(2, 4), params.sample, params.longest).toArrow()
    model = fit(found.column("text").to_pylist(), found.column("_label").to_numpy().astype(float), params)
    return verdicts(scored(docs, model), held_out(2, 4), params.threshold)
