"""Target-distribution importance resampling with word tries: draws the documents whose words look most like a target's.

Features of a text are its words and its pairs of neighbouring words. Each task keeps a trie of the words it has met: a
node of the first level is a word, one below it a pair, and every node holds how often it occurred and the CRC state that
its bytes lead to, so a pair's CRC goes on from its first word's. A node's CRC names its bucket. Tasks merge to totals by
bucket, the totals of both tables give each bucket's gain, and in a second pass the nodes carry gains: a text's weight is
the mean over the paths that its words walk. A draw without replacement in proportion to the weights takes the largest
weights with Gumbel noise made from the id, so it is the same at every run and partitioning.

Tries are arrays sorted by node, walked for all texts of a block at once. One that grows beyond ``nodes`` nodes gives its
counts to the task's totals and starts anew, so memory is bounded whatever the partition holds. Words are told apart by
64-bit hashes of their bytes. Nothing but totals by bucket and one narrow row for each text is shuffled.

Defined cases: null and empty texts, and those without words, have no features and the weight 0 and are never drawn; a null
id is noise of its own and comes after all ids of the same score; repeated rows are drawn each for itself; without documents
of ``least`` words nothing is drawn; an empty target is a flat one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import arrays, ranked, settle

_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_LONG = 48  # bytes of a word beyond which its CRC is made by itself


@dataclass(frozen=True)
class ImportanceParams:
    buckets: int = 10_000
    least: int = 20  # words of a document that can be drawn
    percent: int = 25  # of those documents
    seed: int = 7
    nodes: int = 400_000  # of a task's trie


def _crc_table() -> np.ndarray:
    """CRC-32's step over a byte of zeros, for each low byte of the state."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = (state >> np.uint32(1)) ^ np.where(state & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return state


_STEP = _crc_table()


def extended(states: np.ndarray, alone: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of texts with given states followed by texts with CRCs ``alone``: the state is moved on by ``lengths`` bytes."""
    states = states.copy()
    order = np.argsort(-lengths, kind="stable")
    states, upto = states[order], -np.sort(-lengths)
    for k in range(int(upto[0]) if len(upto) else 0):
        n = int(np.searchsorted(-upto, -k, "left"))  # those longer than k
        states[:n] = (states[:n] >> np.uint32(8)) ^ _STEP[states[:n] & np.uint32(255)]
    out = np.empty_like(states)
    out[order] = states
    return out ^ alone


class WordTrie:
    """Words and, below each, the words that followed it. ``gains`` by bucket are attached to the nodes when given."""

    def __init__(self, p: ImportanceParams, gains: np.ndarray | None = None):
        self.p, self.gains = p, gains
        self.totals = np.zeros(p.buckets, np.int64)
        self._clear()

    def _clear(self) -> None:
        none = np.zeros(0, np.uint64)
        self.words, self.pairs = none, none
        # Of words: CRC, CRC after a space, bytes. Of both levels: counts, and what the node's bucket gives.
        self.crc, self.open, self.length = np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.word_bucket, self.pair_bucket = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.word_count, self.pair_count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def flush(self) -> None:
        """Counts of all nodes go to the totals of their buckets."""
        for bucket, count in ((self.word_bucket, self.word_count), (self.pair_bucket, self.pair_count)):
            self.totals += np.bincount(bucket, weights=count, minlength=self.p.buckets).astype(np.int64)
        self._clear()

    def walk(self, block: bw.Block) -> tuple[np.ndarray, np.ndarray]:
        """Counts the features of a block's texts; their numbers of words and, with gains, the sums of gains by text."""
        if len(self.words) + len(self.pairs) > self.p.nodes:
            self.flush()
        data = bw.LOWER[block.data]
        starts, ends, first = bw.words(block, bw.TERMS)
        n = np.diff(first)
        if not len(starts):
            return n, np.zeros(len(n), np.int64)
        hashes = bw.hash_spans(data, starts, ends)
        keys, at, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        self._grow_words(keys, data, starts[at], ends[at])
        word = np.searchsorted(self.words, keys)
        self.word_count[word] += counts
        linked = np.ones(len(hashes), bool)
        linked[first[1:][n > 0] - 1] = False  # a text's last word has none after it
        left = np.flatnonzero(linked)
        pair = bw.mix(hashes[left] * _PAIR + hashes[left + 1])
        keys, at, pair_inverse, counts = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
        mine = left[at]
        self._grow_pairs(keys, word[inverse[mine]], word[inverse[mine + 1]], data, starts[mine + 1], ends[mine + 1])
        node = np.searchsorted(self.pairs, keys)
        self.pair_count[node] += counts
        if self.gains is None:
            return n, np.zeros(len(n), np.int64)
        value = self.gains[self.word_bucket[word]][inverse]
        value[left] += self.gains[self.pair_bucket[node]][pair_inverse]
        upto = np.concatenate(([0], np.cumsum(value)))
        return n, upto[first[1:]] - upto[first[:-1]]

    def _grow_words(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        fresh = ~_among(keys, self.words)
        keys, starts, ends = keys[fresh], starts[fresh], ends[fresh]
        if not len(keys):
            return
        crc = np.array([zlib.crc32(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint32)
        space = np.full(len(keys), zlib.crc32(b" "), np.uint32)
        where = np.searchsorted(self.words, keys)
        self.open = np.insert(self.open, where, extended(crc, space, np.ones(len(keys), np.int64)))
        self.words, self.crc = np.insert(self.words, where, keys), np.insert(self.crc, where, crc)
        self.length = np.insert(self.length, where, ends - starts)
        self.word_bucket = np.insert(self.word_bucket, where, crc.astype(np.int64) % self.p.buckets)
        self.word_count = np.insert(self.word_count, where, 0)

    def _grow_pairs(self, keys: np.ndarray, parent: np.ndarray, child: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        fresh = np.flatnonzero(~_among(keys, self.pairs))
        if not len(fresh):
            return
        keys, parent, child, starts, ends = keys[fresh], parent[fresh], child[fresh], starts[fresh], ends[fresh]
        lengths = self.length[child]
        crc = extended(self.open[parent], self.crc[child], np.where(lengths > _LONG, 0, lengths))
        for i in np.flatnonzero(lengths > _LONG).tolist():
            crc[i] = zlib.crc32(data[starts[i] : ends[i]], int(self.open[parent[i]]))
        where = np.searchsorted(self.pairs, keys)
        self.pairs = np.insert(self.pairs, where, keys)
        self.pair_bucket = np.insert(self.pair_bucket, where, crc.astype(np.int64) % self.p.buckets)
        self.pair_count = np.insert(self.pair_count, where, 0)


def _among(keys: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Which of the sorted keys the sorted array holds."""
    if not len(there):
        return np.zeros(len(keys), bool)
    return there[np.minimum(np.searchsorted(there, keys), len(there) - 1)] == keys


def _counted(p: ImportanceParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = WordTrie(p)
        for batch in batches:
            for block in bw.blocks(arrays(batch, "text")):
                trie.walk(block)
        trie.flush()
        held = np.flatnonzero(trie.totals)
        yield pa.record_batch([pa.array(held), pa.array(trie.totals[held])], ["bucket", "n"])

    return run


def _scored(p: ImportanceParams, gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, seen = WordTrie(p, gains), 0
        for batch in batches:
            for block in bw.blocks(arrays(batch, "text")):
                n, total = trie.walk(block)
                features = n + np.maximum(n - 1, 0)
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                own = arrays(batch, "doc_id").slice(block.lo, len(n))
                yield pa.record_batch([own, pa.array(np.arange(seen, seen + len(n))), pa.array(n), pa.array(features), pa.array(weight)], ["doc_id", "row", "n", "n_features", "weight"])
                seen += len(n)

    return run


def bucket_totals(texts: DataFrame, p: ImportanceParams = ImportanceParams()) -> np.ndarray:
    """How often each bucket's features occur in the texts: at most ``buckets`` numbers reach the driver."""
    rows = texts.select("text").mapInArrow(_counted(p), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(p.buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much more often a bucket's features occur in the target, add-one smoothed."""
    size, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def resampled(docs: DataFrame, target: DataFrame, params: ImportanceParams = ImportanceParams()) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank), one for each row of ``docs``; rank is null where it is not drawn."""
    p = params
    gains = bucket_gains(bucket_totals(docs, p), bucket_totals(target, p))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(_scored(p, gains), f"doc_id {kind}, row long, n long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    rows = settle(rows.withColumn("score", score))
    able = F.col("n") >= p.least
    drawn = rows.where(able).count() * p.percent // 100
    # Those that can be drawn first, the highest score first; rows alike in all of this are told apart by their place.
    order = {"_late": ~able, "_down": -F.col("score"), "_none": F.col("doc_id").isNull()}
    placed = ranked(rows.withColumns(order), *order, "doc_id", "row")
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1).cast("long")
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


__all__ = ["ImportanceParams", "WordTrie", "bucket_gains", "bucket_totals", "extended", "resampled"]
