"""N-gram Jaccard join through count vectors: exact links between near-duplicate texts and their groups.

A text's set holds its distinct word shingles. Each set's shingles are hashed into groups and counted; the counts are a
point, and the sum over coordinates of the smaller of two counts bounds the overlap of two sets. Points are held in
R-trees packed bottom-up, whose inner nodes keep coordinate-wise maxima: a branch whose bound falls below the overlap
that the threshold demands is never opened. Surviving pairs are verified on the sets themselves.

One tree over the corpus would be one task and, in many dimensions, a full scan. So trees are built per *prefix key*:
if two sets reach the threshold, they share one of the first |A| - ceil(t|A|) + 1 shingles of each in any one fixed order
of all shingles; and a prefix longer by e makes them share e + 1 of them. The order is by how common a shingle is over all texts, then by hash, so passages that many documents
share come last and make no keys. Sets that meet under a key are compared there; nothing that could link is left out.

Skew: equal texts are folded to their smallest id before anything else. A key that more than ``few`` sets share joins each
to the key's three smallest ids first; when the groups found that way are known, only keys whose sets lie in several groups
are kept, and of these trees return pairs across groups only. So a family of thousands of near copies costs a few
comparisons each, not all pairs. How common a key is, is known before it moves: very common ones are salted into pieces of
about ``piece`` sets, whose first sets meet afterwards. A set with more than ``hub`` pairs is repeated for pieces of them, so
that no task compares all of a large family with one set. Trees are made of blocks of at most ``block`` sets; a larger key is compared block by block, in
separate tasks. Links are complete between groups: every pair of linked texts ends in one component.

Words and shingles are compared as 64-bit hashes (polynomials modulo 2**64, scrambled), not as strings.

Defined cases: null text, empty text and text without words: an empty set, linked with nothing; fewer words than the
shingle: the whole sequence is the one shingle; repeated rows of one id and text are one document, and an id with several
texts has the links of all of them; ids must not be null (such rows keep a null component); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import arrays, ranked, settle, settle_by, tidy
from .components import components, forest


@dataclass(frozen=True)
class JaccardParams:
    width: int = 5
    percent: int = 75  # links: 100 * intersection >= percent * union
    blocks: int = 128  # parts in which the table of counts is summed
    groups: int = 128  # coordinates of a point in a tree
    widest: int = 16384  # most coordinates of a set's own vector, which has one for every second shingle
    slot_bits: int = 23  # of the table of how common shingles are
    more: int = 40  # a set has a further key for so many shingles
    few: int = 12  # sets of a key that are paired at once
    piece: int = 2048  # sets of a salted key's piece, about
    hub: int = 5000  # pairs of one set that a task compares
    block: int = 2000  # sets of a tree
    fan: int = 16  # children of a node


# ---------------------------------------------------------------- sets and their digests


def _count_vectors(found: np.ndarray, at: np.ndarray, p: JaccardParams) -> list[bytes]:
    """Each set's counts by hash group; the number of groups is a power of two that follows the set's size."""
    sizes = np.diff(at)
    wide = np.clip(1 << np.ceil(np.log2(np.maximum(sizes, 2) / 2)).astype(np.int64), p.groups, p.widest)
    begin = np.concatenate(([0], np.cumsum(wide)))
    low = np.repeat(wide - 1, sizes).astype(np.uint64)
    code = np.repeat(begin[:-1], sizes) + (found & low).astype(np.int64)
    counts = np.minimum(np.bincount(code, minlength=int(begin[-1])), 65535).astype("<u2")
    return [counts[begin[i] : begin[i + 1]].tobytes() for i in range(len(sizes))]


def _folded(vector: bytes, groups: int) -> np.ndarray:
    """The same set's counts over fewer groups."""
    return np.frombuffer(vector, "<u2").astype(np.int32).reshape(-1, groups).sum(0)


def _overlap_bound(x: bytes, y: bytes) -> int:
    """Summed coordinate minima of two sets' counts, over as many groups as both have."""
    groups = min(len(x), len(y)) // 2
    return int(np.minimum(_folded(x, groups), _folded(y, groups)).sum())


def _digests(p: JaccardParams):
    """Per text (kind 0): size and count vector; per task (kind 1): blocks of a table of how often slots of shingles occurred."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << p.slot_bits, np.uint32)
        seen = 0
        for batch in batches:
            keys = arrays(batch, "doc_id").to_numpy(zero_copy_only=False)
            for block in bw.blocks(arrays(batch, "text")):
                found, at = bw.shingles(block, p.width)
                seen += len(found)
                np.add.at(slots, (found >> np.uint64(64 - p.slot_bits)).astype(np.int64), np.uint32(1))
                n = len(at) - 1
                yield pa.record_batch([
                    pa.array(np.zeros(n, np.int32)), pa.array(keys[block.lo : block.hi]), pa.array(np.diff(at)),
                    pa.array(_count_vectors(found, at, p), pa.binary()),
                ], ["kind", "id", "n", "vector"])
        if seen:
            yield pa.record_batch([pa.array(np.ones(p.blocks, np.int32)), pa.array(np.arange(p.blocks)), pa.array(np.zeros(p.blocks, np.int64)), pa.array([_packed_counts(x) for x in slots.reshape(p.blocks, -1)], pa.binary())], ["kind", "id", "n", "vector"])

    return run


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts of a block's slots, compressed: a byte for each, and beside it the few that are beyond a byte, in full."""
    heavy = np.flatnonzero(counts > 255)
    small = zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes(), 1)
    return np.array([len(heavy)], "<i8").tobytes() + heavy.astype("<i8").tobytes() + counts[heavy].astype("<i8").tobytes() + small


def _unpacked_counts(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed, "<i8", 1)[0])
    heavy, full = np.frombuffer(packed, "<i8", n, 8), np.frombuffer(packed, "<i8", n, 8 + 8 * n)
    counts = np.frombuffer(zlib.decompress(packed[8 + 16 * n :]), np.uint8).astype(np.int64)
    counts[heavy] = full
    return counts


def _order_table(rows: DataFrame, total: int, p: JaccardParams) -> np.ndarray:
    """Class of each slot: the power of two of its count over all texts, 0 unless it stands out; 2**slot_bits bytes.

    Tasks' tables are summed block by block, in two steps so that no task adds up those of all tasks.
    """

    size, mean = (1 << p.slot_bits) // p.blocks, total / (1 << p.slot_bits)

    def added(last: bool):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            counts = np.zeros(size, np.int64)
            for x in frame["vector"]:
                counts += _unpacked_counts(x)
            if not last:
                return pd.DataFrame({"id": frame["id"].iloc[:1], "vector": [_packed_counts(counts)]})
            classes = np.where(counts >= 12 + mean + 6 * mean**0.5, np.log2(np.maximum(counts, 1)), 0).astype(np.uint8)
            return pd.DataFrame({"id": frame["id"].iloc[:1], "vector": [classes.tobytes()]})

        return run

    salts = 1 + rows.count() // p.blocks // 64
    rows = rows.select("id", "vector", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    if salts > 1:
        rows = rows.groupBy("id", "salt").applyInPandas(added(False), "id long, vector binary")
    got = rows.groupBy("id").applyInPandas(added(True), "id long, vector binary").toArrow()
    table = np.zeros((p.blocks, size), np.uint8)
    for block, x in zip(got.column("id").to_pylist(), got.column("vector"), strict=True):
        table[block] = np.frombuffer(x.as_buffer(), np.uint8)
    return table.ravel()


def _prefix_keys(p: JaccardParams, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = table.value
        for batch in batches:
            keys = arrays(batch, "doc_id").to_numpy(zero_copy_only=False)
            for block in bw.blocks(arrays(batch, "text")):
                found, at = bw.shingles(block, p.width)
                sizes = np.diff(at)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                rank = classes[(found >> np.uint64(64 - p.slot_bits)).astype(np.int64)]
                order = np.lexsort((bw.mix(found), rank, owner))
                take = np.where(sizes > 0, sizes - -(-sizes * p.percent // 100) + 1 + sizes // p.more, 0)
                first = bw.ranges(at[:-1], at[:-1] + take)
                chosen, common = found[order][first].view(np.int64), rank[order][first].astype(np.int64)
                # Classes are powers of two of how often a slot occurred, so they say how many pieces a key needs.
                pieces = np.maximum((np.int64(1) << common) // p.piece, 1)
                own = np.repeat(bw.mix(keys[block.lo : block.hi].astype(np.int64).view(np.uint64)), take)
                salt = np.where(pieces > 1, 1 + (own % pieces.astype(np.uint64)).astype(np.int64), 0).astype(np.int32)
                bounds = np.concatenate(([0], np.cumsum(take))).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(chosen), pa.array(salt)], ["key", "salt"])
                yield pa.record_batch([pa.array(keys[block.lo : block.hi]), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(pa.array(bounds), pairs)], ["id", "n", "keys"])

    return run


# ---------------------------------------------------------------- meeting under keys


def _key_groups(batches: Iterator[pa.RecordBatch], width: int = 1) -> Iterator[list[np.ndarray]]:
    """Columns of whole key groups, from batches sorted by their first ``width`` columns; a group may span batches."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        last = np.ones(batch.num_rows, bool)
        for c in columns[:width]:
            last &= c == c[-1]
        cut = int(last.argmax())  # where the last group of the batch begins, rows being sorted
        if held and (cut or any(c[0] != h[-1] for c, h in zip(columns[:width], held[-1][:width], strict=True))):
            # The group held so far ends in this batch or before it.
            yield [np.concatenate(x) for x in zip(*held, [c[:cut] for c in columns], strict=True)]
            held = []
        elif cut:
            yield [c[:cut] for c in columns]
        held.append([c[cut:] for c in columns])
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _meet(p: JaccardParams, again: bool = False):
    """From (key, salt, id, n) sorted by key and salt: pairs (kind 0), the rows of keys with more than ``few`` sets (kind 1),
    and some sets of each piece of a salted key (kind 2). ``again`` is the meeting of these last: pairs only."""

    def fits(n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(n, m) >= p.percent * np.maximum(n, m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, salt, ident, n in _key_groups(batches, 2):
            first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))))
            size = np.diff(np.concatenate((first, [len(key)])))
            place = np.arange(len(key)) - np.repeat(first, size)
            crowd = np.repeat(size, size)
            left, right = [], []

            def pair(at: np.ndarray, to: np.ndarray) -> None:
                good = fits(n[at], n[to])
                left.append(ident[to[good]])
                right.append(ident[at[good]])

            small = (crowd <= p.few) & (salt == 0)
            for gap in range(1, min(int(size.max()), p.few)):
                at = np.flatnonzero((place >= gap) & small)
                pair(at, at - gap)
            # Larger keys: a star on the three smallest ids, which are the same ones under most of a family's keys.
            for lead in range(3):
                at = np.flatnonzero(~small & (place > lead))
                pair(at, np.repeat(first, size)[at] + lead)
            many = np.flatnonzero(~small)
            if len(many):
                if not again:
                    ahead = np.flatnonzero((salt > 0) & (place < 3))
                    kind = np.repeat(np.array([1, 2], np.int32), [len(many), len(ahead)])
                    rows = np.concatenate([many, ahead])
                    yield pa.record_batch([pa.array(kind), pa.array(key[rows]), pa.array(ident[rows]), pa.array(n[rows].astype(np.int32))], ["kind", "a", "b", "n"])
            a, b = np.concatenate(left or [ident[:0]]), np.concatenate(right or [ident[:0]])
            if len(a):
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                yield pa.record_batch([pa.array(np.zeros(len(pairs), np.int32)), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), pa.nulls(len(pairs), pa.int32())], ["kind", "a", "b", "n"])

    return run


class CountTree:
    """An R-tree over count vectors, packed from the points in order of their sizes; nodes keep maxima of coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fan: int):
        self.order = np.argsort(sizes, kind="stable")
        self.fan, self.levels = fan, []
        top, least, most = points[self.order].astype(np.int32), sizes[self.order], sizes[self.order]
        self.levels.append((top, least, most))
        while len(top) > 1:
            at = np.arange(0, len(top), fan)
            top, least, most = np.maximum.reduceat(top, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((top, least, most))

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Positions of points whose bound on the overlap with ``point`` reaches what the threshold demands."""
        nodes = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            top, least, most = self.levels[depth]
            if depth < len(self.levels) - 1:
                nodes = bw.ranges(nodes * self.fan, np.minimum((nodes + 1) * self.fan, len(top)))
            low, high = least[nodes], most[nodes]
            nodes = nodes[(100 * high >= percent * size) & (100 * size >= percent * low)]
            if not len(nodes):
                break
            smallest = np.maximum(least[nodes], -(-percent * size // 100))
            bound = np.minimum(top[nodes], point).sum(1)
            nodes = nodes[(100 + percent) * bound >= percent * (size + smallest)]
        return self.order[nodes]


def _cross_pairs(p: JaccardParams):
    """From (tree, side, id, n, component, key, keys, vector) sorted by tree: pairs across components that it cannot exclude.

    ``side`` is 0 for a block's own sets and 1 for those of a later block that are compared with them. ``keys`` are all
    keys of a set, where it occurs under several: of two sets' common keys only the lowest gives the pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _key_groups(batches):
            key, side, ident, n, comp, own_key, keys, vectors = columns
            points = np.stack([_folded(v, p.groups) for v in vectors])
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            for lo, hi in zip(first, [*first[1:], len(key)], strict=True):
                mine = np.arange(lo, hi)
                base = mine[side[lo:hi] == 0]
                if not len(base):
                    continue
                other = mine[side[lo:hi] == 1] if (side[lo:hi] == 1).any() else base
                tree = CountTree(points[base], n[base], p.fan)
                left, right = [], []
                for i in other:
                    hits = base[tree.search(points[i], int(n[i]), p.percent)]
                    hits = hits[comp[hits] != comp[i]]
                    # The sets' own, wider vectors bound more closely.
                    near = [_overlap_bound(vectors[i], vectors[j]) for j in hits]
                    hits = hits[(100 + p.percent) * np.array(near, np.int64) >= p.percent * (n[i] + n[hits])]
                    if keys[i] is not None:
                        hits = hits[[np.intersect1d(keys[i], keys[j]).min() == own_key[i] for j in hits]] if len(hits) else hits
                    left.append(np.full(len(hits), ident[i]))
                    right.append(ident[hits])
                a, b = np.concatenate(left), np.concatenate(right)
                if len(a):
                    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                    yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    return run


# ---------------------------------------------------------------- verification


def _set_rows(p: JaccardParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in bw.blocks(arrays(batch, "text")):
                found, at = bw.shingles(block, p.width)
                own = arrays(batch, "doc_id").slice(block.lo, block.hi - block.lo)
                yield pa.record_batch([own, pa.array([found[at[i] : at[i + 1]].tobytes() for i in range(len(at) - 1)], pa.binary())], ["id", "shingles"])

    return run


def _bounded(p: JaccardParams):
    """Of (a, b, n, m, vector of a, vector of b): the pairs whose summed minima do not exclude a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            bound = np.array([_overlap_bound(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)], np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array((100 + p.percent) * bound >= p.percent * (n + m)))

    return run


def _verified(p: JaccardParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(long, short)
                both = int((long[np.minimum(at, len(long) - 1)] == short).sum())
                keep[i] = 100 * both >= p.percent * (len(x) + len(y) - both)
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return run


def _with_both(pairs: DataFrame, sets: DataFrame, columns: dict[str, tuple[str, str]], hubs: DataFrame | None, p: JaccardParams) -> DataFrame:
    """Pairs (a, b) with columns of both sets. Pairs of a hub join copies of its row, one for each piece of the pairs."""
    x = sets.select(F.col("id").alias("a"), *[F.col(c).alias(n) for c, (n, _) in columns.items()])
    y = sets.select(F.col("id").alias("b"), *[F.col(c).alias(n) for c, (_, n) in columns.items()])
    if hubs is None:
        return pairs.join(x, "a").join(y, "b")
    plain = pairs.join(hubs, "a", "left_anti").join(x, "a")
    copies = x.join(hubs, "a").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    salted = pairs.join(hubs, "a").withColumn("piece", F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int")).drop("pieces")
    return plain.unionByName(salted.join(copies, ["a", "piece"]).drop("piece")).join(y, "b")


def _hubs(pairs: DataFrame, p: JaccardParams) -> DataFrame | None:
    """(a, pieces) of the sets with very many pairs, if there are any."""
    counts = pairs.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > p.hub)
    hubs = settle(counts.select("a", F.ceil(F.col("n") / p.hub).cast("int").alias("pieces")))
    return None if hubs.isEmpty() else hubs


def _links(pairs: DataFrame, sets: DataFrame, texts: DataFrame, p: JaccardParams) -> DataFrame:
    """The pairs that reach the threshold: first by count vectors, then by the sets of the texts that are left."""
    pairs = settle(pairs)
    hubs = _hubs(pairs, p)
    both = _with_both(pairs, sets, {"n": ("n", "m"), "vector": ("va", "vb")}, hubs, p)
    near = settle(both.select("a", "b", "n", "m", "va", "vb").mapInArrow(_bounded(p), "a long, b long"))
    wanted = near.select(F.col("a").alias("doc_id")).union(near.select(F.col("b").alias("doc_id"))).distinct()
    rows = settle(texts.join(wanted, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_set_rows(p), "id long, shingles binary"))
    both = _with_both(near, rows, {"shingles": ("sa", "sb")}, hubs, p)
    return both.select("a", "b", "sa", "sb").mapInArrow(_verified(p), "a long, b long")


# ---------------------------------------------------------------- the operator


def jaccard_groups(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each distinct id of ``docs``.

    An id that stands with several texts has the links of all of them, and the size of the text with the lowest digest.
    """
    found = _grouped(docs.select("doc_id", "text"), params)
    match = [found.ids[k].eqNullSafe(found.texts[k]) for k in _DIGEST]
    per_row = found.ids.join(found.texts, match, "left").select(
        "doc_id", *[found.ids[k] for k in _DIGEST], "node", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component"), F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles")
    )
    if not found.several:
        return per_row.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    # The texts of an id are one node more: a star on the smallest of them.
    per_row = settle(per_row)
    worded = per_row.where("doc_id is not null and n_shingles > 0")
    least = worded.groupBy("doc_id").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    edges = worded.join(least, "doc_id").select("a", F.col("node").alias("b"))
    both = components(found.links.unionByName(edges)).select(F.col("id").alias("node"), F.col("component").alias("_c"))
    wider = per_row.join(both, "node", "left").withColumn("component", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("_c", "node")))
    first = F.min(F.struct(*_DIGEST, "n_shingles"))["n_shingles"]
    return wider.groupBy("doc_id").agg(first.alias("n_shingles"), F.coalesce(F.min("component"), F.col("doc_id")).alias("component_id"))


_DIGEST = ("h", "c", "l")
_NODE = "_jaccard_node"


@dataclass
class _Groups:
    """``ids``: (doc_id, digest), one row for each text of an id. ``texts``: (digest, node, n_shingles, component), one for each
    distinct text. ``links`` between nodes. ``rows``: one document for each text that is not empty, bucketed by its node.
    ``several``: whether some id stands with more than one text."""

    ids: DataFrame
    texts: DataFrame
    links: DataFrame
    rows: DataFrame
    several: bool


def _numbered_texts(docs: DataFrame, digest: list) -> tuple[DataFrame, DataFrame, bool, bool]:
    """Rows (doc_id, digest) of every id and text; rows (digest, lead, node) of every text; whether ids, and whether rows, repeat.

    A text's node is the smallest id that has it. Where an id is that of several texts, the one with the lowest digest has
    it, and the others get numbers beyond all ids, so a group's smallest node is an id.
    """
    firsts = settle(docs.select("doc_id", *digest).groupBy("doc_id").agg(F.min(F.struct(*_DIGEST)).alias("d"), F.max(F.struct(*_DIGEST)).alias("e"), F.count("*").alias("rows")))
    repeated = not firsts.where("rows > 1").isEmpty()
    crowded = firsts.where("doc_id is not null and not d <=> e")
    several = repeated and not crowded.isEmpty()
    ids = firsts.select("doc_id", "d.*")
    if several:
        more = docs.select("doc_id", *digest).join(crowded.select("doc_id"), "doc_id", "left_semi").distinct()
        ids = settle(firsts.where("doc_id is null or d <=> e").select("doc_id", "d.*").unionByName(more))
    same = settle(ids.where("doc_id is not null").groupBy(*_DIGEST).agg(F.min("doc_id").alias("lead")))
    if not several:
        return ids, same.withColumn("node", F.col("lead")), False, repeated
    shared = same.groupBy("lead").agg(F.min(F.struct(*_DIGEST)).alias("own"), F.count("*").alias("n")).where("n > 1")
    others = same.join(shared, "lead").where(~F.struct(*_DIGEST).eqNullSafe(F.col("own"))).select(*_DIGEST)
    beyond = ids.agg(F.max("doc_id")).first()[0] + 1
    others = ranked(others, *_DIGEST).select(*[F.col(k).alias(f"_{k}") for k in _DIGEST], (F.col("pos") + F.lit(beyond)).alias("_number"))
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _DIGEST]
    return ids, settle(same.join(others, match, "left").select(*_DIGEST, "lead", F.coalesce("_number", "lead").alias("node"))), True, repeated


def _grouped(docs: DataFrame, p: JaccardParams) -> _Groups:
    spark = docs.sparkSession
    # Equal texts first: one row for each, by a 96-bit digest and the length, nothing but digests is shuffled.
    digest = [F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("c"), F.octet_length("text").alias("l")]
    ids, same, several, repeated = _numbered_texts(docs, digest)
    leads = same.where("l > 0").select(F.col("lead").alias("doc_id"), *_DIGEST, "node")
    # The lead's row again, by id; the digest is compared in a form that keeps the id the only key of the join, so that
    # texts move once, to the buckets that later joins use.
    text = F.col("x.text")
    ours = (F.xxhash64(text), F.crc32(text.cast("binary")), F.octet_length(text))
    same_text = (ours[0].bitwiseXOR(F.col("y.h")) == 0) & (ours[1] - F.col("y.c") == 0) & (ours[2] - F.col("y.l") == 0)
    rows = docs.alias("x").join(leads.alias("y"), (F.col("x.doc_id") == F.col("y.doc_id")) & same_text)
    rows = rows.select(*[F.col(f"x.`{c}`") for c in docs.columns], F.col("y.node").alias(_NODE))
    if repeated:
        rows = rows.dropDuplicates([_NODE])
    rows = settle_by(rows, _NODE)
    texts = rows.select(F.col(_NODE).alias("doc_id"), "text")
    found = settle(texts.mapInArrow(_digests(p), "kind int, id long, n long, vector binary"))
    total = found.agg(F.sum("n")).first()[0] or 0
    table = spark.sparkContext.broadcast(_order_table(found.where("kind = 1"), total, p))
    # Vectors move once as well, to the buckets of their ids.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = settle_by(found.where("kind = 0").select("id", "n", "vector").repartition(parts, "id"), "id")
    keyed = (
        texts.mapInArrow(_prefix_keys(p, table), "id long, n int, keys array<struct<key:long,salt:int>>")
        .select(F.explode("keys").alias("k"), "id", "n").select("k.key", "k.salt", "id", "n")
        .repartition("key", "salt")
        .sortWithinPartitions("key", "salt", "id")
    )
    met = settle(keyed.mapInArrow(_meet(p), "kind int, a long, b long, n int"))
    pairs = met.where("kind = 0").select("a", "b")
    ahead = met.where("kind = 2").select(F.col("a").alias("key"), F.lit(0).alias("salt"), F.col("b").alias("id"), "n")
    if not ahead.isEmpty():
        ahead = ahead.repartition("key").sortWithinPartitions("key", "id")
        pairs = pairs.unionByName(ahead.mapInArrow(_meet(p, again=True), "kind int, a long, b long, n int").select("a", "b"))
    pairs = pairs.distinct()
    links = settle(_links(pairs, sets, texts, p))
    tidy(spark)
    many = met.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("id"), "n")
    links = links.unionByName(_late_links(many, links, sets, texts, p))
    tidy(spark)
    # Back to all texts.
    groups = components(links)
    sizes = sets.select(F.col("id").alias("node"), F.col("n").alias("n_shingles"))
    per_text = (
        same.join(sizes, "node", "left").join(groups.withColumnRenamed("id", "node"), "node", "left")
        .select(*_DIGEST, "node", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).alias("component"))
    )
    return _Groups(ids, per_text, links, rows, several)


def _late_links(many: DataFrame, links: DataFrame, sets: DataFrame, texts: DataFrame, p: JaccardParams) -> DataFrame:
    """Links across the groups known so far, from the keys that more than ``few`` sets share."""
    empty = links.where("false").select("a", "b")
    if many.isEmpty():
        return empty
    known = components(links) if not links.isEmpty() else None
    # Two sets that no smaller key has paired share more than `e` keys, all of them large, where `e` is the lesser number
    # of their further keys. Sets with too few large keys drop out, then keys that hold one component only; twice.
    rows = many if known is None else many.join(known, "id", "left")
    rows = settle(rows.select("key", "id", "n", F.coalesce("component", "id").alias("component") if known is not None else F.col("id").alias("component")))
    needed = F.floor(F.ceil(F.col("n") * p.percent / 100) / p.more) + 1
    members = [F.bit_xor(F.xxhash64(F.lit(i), F.col("id"))).alias(f"m{i}") for i in (1, 2)]
    for _ in range(2):
        busy = rows.groupBy("id", "n").agg(F.count("*").alias("keys")).where(F.col("keys") >= needed).select("id")
        rows = rows.join(busy, "id", "left_semi")
        split = settle(rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"), *members).where("x <> y"))
        rows = settle(rows.join(split, "key", "left_semi"))
    split = split.select("key", "size", "m1", "m2")
    # Of keys with the same sets one is enough.
    split = settle(split.groupBy("size", "m1", "m2").agg(F.min("key").alias("key")).select("key", "size"))
    if split.isEmpty():
        return empty
    rows = settle(rows.select("key", "id", "component").join(split, "key"))
    # Sets that keys tie together form clusters (keys are nodes as well). A cluster is compared as a whole, each set in it
    # once, or key by key, whichever costs less in comparisons and rows; more than a block of sets go block by block:
    # within each and between each two.
    ties = settle(components(rows.select(F.col("key").alias("a"), F.col("id").alias("b"))))
    members = rows.select("id", "component").distinct().join(ties.withColumnRenamed("component", "cluster"), "id")
    work = split.join(ties.select(F.col("id").alias("key"), F.col("component").alias("cluster")), "key")
    m, each = F.col("m").cast("double"), 1000.0  # a row costs about as much as so many comparisons
    sizes = members.groupBy("cluster").agg(F.count("*").alias("m"))
    costs = work.groupBy("cluster").agg(F.sum(F.col("size").cast("double") * F.col("size") + each * F.col("size")).alias("by_key"))
    whole = settle(sizes.join(costs, "cluster").select("cluster", "m", (m * m + each * m * F.ceil(m / p.block) <= F.col("by_key")).alias("whole")))
    single = members.join(whole.where("whole or m <= %d" % p.block), "cluster").select(F.col("cluster").alias("key"), "id", "component", F.col("m").alias("size"), F.lit(None).cast("array<long>").alias("keys"))
    by_key = work.join(whole.where("not whole and m > %d" % p.block), "cluster").select("key")
    many_keys = rows.join(by_key, "key", "left_semi")
    lists = many_keys.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))  # at most a prefix long
    rows = many_keys.select("key", "id", "component", "size").join(lists, "id").select("key", "id", "component", "size", "keys").unionByName(single)
    blocks = F.ceil(F.col("size") / p.block).cast("int")
    rows = settle(rows.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("blocks", blocks))
    near = F.lit(-1)
    inner = rows.select(F.xxhash64("key", near, "own").alias("k"), F.lit(0).alias("side"), "id", "component", "key", "keys")
    # Two blocks: the lower one's sets once more for each higher one, which asks.
    lower = rows.where("own + 1 < blocks").withColumn("high", F.explode(F.sequence(F.col("own") + 1, F.col("blocks") - 1)))
    lower = lower.select(F.xxhash64("key", "high", "own").alias("k"), F.lit(0).alias("side"), "id", "component", "key", "keys")
    higher = rows.where("own > 0").withColumn("low", F.explode(F.sequence(F.lit(0), F.col("own") - 1)))
    higher = higher.select(F.xxhash64("key", "own", "low").alias("k"), F.lit(1).alias("side"), "id", "component", "key", "keys")
    all_rows = inner.unionByName(higher).unionByName(lower).join(sets.select("id", "n", "vector"), "id").select("k", "side", "id", "n", "component", "key", "keys", "vector")
    all_rows = all_rows.repartition("k").sortWithinPartitions("k", "id")
    pairs = settle(all_rows.mapInArrow(_cross_pairs(p), "a long, b long").distinct())
    return _links(pairs, sets, texts, p)


def one_of_each(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """The documents that are the smallest id of their group, all columns as they were; rows with a null id stay.

    Rows without words belong to no group and stay as they are. All others are taken from the bucketed rows that the
    groups were found on, so texts are not moved again. Of rows that repeat an id and its text one is kept; where an id
    has several texts, each is in the group of its own links.
    """
    found = _grouped(docs, params)
    drop = found.texts.where("component <> node").select(F.col("node").alias(_NODE))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = found.rows.where(worded).join(drop, _NODE, "left_anti").select(docs.columns)
    return kept.unionByName(docs.where(~worded | F.col("doc_id").isNull()))


__all__ = ["CountTree", "JaccardParams", "forest", "jaccard_groups", "one_of_each"]
