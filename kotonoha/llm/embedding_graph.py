"""Embedding near-duplicates through a robust-pruned flat graph.

Vectors are dealt to the nearest ``overlap`` of many cells, so cells overlap. Centres come from k-means on a bounded sample,
at most ``fan`` of them at a time: where that leaves cells of more than ``leaf`` vectors, each of these is fitted and dealt
again on its own, so a cell's size does not follow the table's. Centres as near to each other as the threshold are one: a
dense family is never cut up, since all its members link anyway.

Each cell's shard builds a graph of its own, on vectors of one byte a component: candidate neighbours of every vector plus
some random ones are pruned robustly (a candidate is dropped if a kept one is much nearer to it than the vector is). The
shards' adjacency lists of a vector are united; where a shard is searched, reverse edges are added and separate pieces tied
together. Every vector is searched for in every cell it belongs to: greedy search starts at the nearest medoids, and its
range expands from every vector found near the threshold until nothing new turns up. Found pairs are verified by cosine in
double precision. A pair counts, for both ends, in the lowest cell that both belong to, so counts are symmetric.

At last recall is audited on a bounded sample of queries against all vectors, as a share of all links and as the queries'
average share. Below ``recall`` everything is repeated with twice the overlap and width; after the last try an exact pass
follows: a vector then belongs to every cell in which the triangle inequality leaves room for a link (angle to the centre
within the cell's radius and the threshold's angle), and cells are compared whole.

Skew: equal vectors are folded to their smallest id and counted with their number. A cell with more than ``part`` vectors is
dealt into parts, and each two parts are searched in a task of their own. Tasks give counts and star-shaped edges, not all
pairs, so a dense group costs comparisons but no rows.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
unequal length do not link, those of equal length do (lengths with few vectors are compared whole); repeated rows of one id
count once; null ids are dropped; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .bytewords import ranges
from .common import settle
from .components import components, forest

LEAST_RECALL = 0.9  # below this even after the exact pass there is no result

@dataclass(frozen=True)
class GraphParams:
    threshold: float = 0.9
    leaf: int = 500  # vectors of a cell, about
    fan: int = 1000  # most centres of one fit
    levels: int = 4  # of fits one below the other, at most
    part: int = 4000  # most vectors of one graph
    overlap: int = 2
    pool: int = 32  # candidates of a node before pruning
    degree: int = 12
    alpha: float = 1.2
    beam: int = 12
    starts: int = 4
    slack: float = 0.12  # the range expands from vectors this much below the threshold
    sample: int = 20_000  # vectors that one fit sees at most
    audit: int = 200  # queries of the audit
    recall: float = 0.97
    tries: int = 2  # before the exact pass


def _matrix(column) -> np.ndarray:
    """Rows of a list column, whose lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the bounds of its lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.array([0], np.int64) if not len(column) else np.concatenate(([0], column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True, initial=1e-300)
    return rows / np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-300)


def clusters_of(sample: np.ndarray, k: int, apart: float, rounds: int = 8) -> np.ndarray:
    """Centres by spherical k-means; empty ones and those nearer than the cosine ``apart`` to a kept one are dropped."""
    rng = np.random.default_rng(5)
    unit = _unit(sample).astype(np.float32)
    centres = unit[rng.choice(len(unit), min(k, len(unit)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(unit[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(unit), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        norms = np.sqrt((sums * sums).sum(1))
        order = np.argsort(-np.bincount(near, minlength=len(centres)), kind="stable")
        order = order[norms[order] > 0]
        centres = sums[order] / norms[order][:, None]
    alike, kept = centres @ centres.T >= apart, np.ones(len(centres), bool)
    for i in range(len(centres)):
        if kept[i]:
            kept[i + 1 :] &= ~alike[i, i + 1 :]
    return centres[kept]


def build_graph(unit: np.ndarray, p: GraphParams) -> tuple[np.ndarray, np.ndarray]:
    """Directed edges (from, to) of the pruned graph."""
    n = len(unit)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rng = np.random.default_rng(n)
    pool, extra = min(p.pool, n - 1), min(8, n - 1)
    starts, ends = [], []
    for lo in range(0, n, 256):
        own = np.arange(lo, min(lo + 256, n))
        sims = unit[own] @ unit.T
        sims[np.arange(len(own)), own] = -2
        near = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
        cand = np.concatenate([near, rng.integers(0, n, (len(own), extra))], 1)
        dist = 1 - np.take_along_axis(sims, cand, 1)
        order = np.argsort(dist, 1, kind="stable")
        cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
        vectors = unit[cand]
        between = 1 - vectors @ vectors.transpose(0, 2, 1)
        alive = cand != own[:, None]
        rows = np.arange(len(own))
        for _ in range(p.degree):
            pick = alive.argmax(1)
            some = alive[rows, pick]
            if not some.any():
                break
            starts.append(own[some])
            ends.append(cand[rows, pick][some])
            alive &= ~((p.alpha * between[rows, pick] <= dist) & some[:, None])
            alive[rows, pick] = False
    a, b = np.concatenate(starts), np.concatenate(ends)
    edges = np.unique(a * n + b)
    return edges // n, edges % n


def both_ways(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges and their reverses, separate pieces tied together as a tree: bounds and neighbours of each of ``n`` nodes."""
    nodes, root = forest(np.concatenate([a, np.arange(n)]), np.concatenate([b, np.arange(n)]))
    roots = np.unique(root)
    if len(roots) > 1:
        child = np.arange(1, len(roots))
        a, b = np.concatenate([a, roots[child]]), np.concatenate([b, roots[(child - 1) // 8]])
    edges = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.searchsorted(edges // n, np.arange(n + 1)), edges % n


def medoids(unit: np.ndarray) -> np.ndarray:
    """The vector nearest to the mean, for the whole and for about sqrt(n) regions."""
    n = len(unit)
    pivots = unit[np.random.default_rng(n).choice(n, max(1, int(n**0.5)), replace=False)]
    region = (unit @ pivots.T).argmax(1)
    sums = np.zeros_like(pivots)
    np.add.at(sums, region, unit)
    own = (unit * sums[region]).sum(1)
    order = np.lexsort((-own, region))
    first = np.concatenate(([True], region[order][1:] != region[order][:-1]))
    return np.unique(np.append(order[first], (unit @ unit.mean(0)).argmax()))


def range_search(unit: np.ndarray, at: np.ndarray, to: np.ndarray, entry: np.ndarray, queries: np.ndarray, p: GraphParams) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with similarity near the threshold or above. ``to[at[i]:at[i+1]]`` are the neighbours of i."""
    n, q = len(unit), len(queries)
    if not n or not q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros((q, n), bool)
    found_q, found_n = [], []
    # Greedy: each query keeps its best `beam` nodes and opens the best unopened one.
    first = queries @ unit[entry].T
    few = min(p.starts, len(entry), p.beam)
    top = np.argsort(-first, 1)[:, :few]
    width = p.beam
    beam = np.full((q, width), -1, np.int64)
    score = np.full((q, width), -2.0, np.float32)
    opened = np.ones((q, width), bool)
    beam[:, :few] = entry[top]
    score[:, :few] = np.take_along_axis(first, top, 1)
    opened[:, :few] = False
    seen[np.arange(q)[:, None], beam[:, :few]] = True
    all_q, all_n, all_s = [np.repeat(np.arange(q), few)], [beam[:, :few].ravel()], [score[:, :few].ravel()]

    def fresh(query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unseen neighbours of the nodes, for their queries, with similarities."""
        new_q = np.repeat(query, at[node + 1] - at[node])
        new_n = to[ranges(at[node], at[node + 1])]
        code = np.unique((new_q * n + new_n)[~seen[new_q, new_n]])
        new_q, new_n = code // n, code % n
        seen[new_q, new_n] = True
        sims = np.empty(len(code), np.float32)
        for i in range(0, len(code), 50_000):
            sims[i : i + 50_000] = np.einsum("ij,ij->i", queries[new_q[i : i + 50_000]], unit[new_n[i : i + 50_000]])
        return new_q, new_n, sims

    for _ in range(20 * width):
        open_score = np.where(opened, -3, score)
        pick = open_score.argmax(1)
        go = np.flatnonzero(open_score[np.arange(q), pick] > -2.5)
        if not len(go):
            break
        opened[go, pick[go]] = True
        new_q, new_n, sims = fresh(go, beam[go, pick[go]])
        all_q.append(new_q)
        all_n.append(new_n)
        all_s.append(sims)
        if not len(new_q):
            continue
        # Merge: new ones beside the beam, best first.
        place = np.arange(len(new_q)) - np.searchsorted(new_q, new_q, "left")
        rows, inverse = np.unique(new_q, return_inverse=True)
        more = int(place.max()) + 1
        nodes = np.concatenate([beam[rows], np.full((len(rows), more), -1)], 1)
        scores = np.concatenate([score[rows], np.full((len(rows), more), -2, np.float32)], 1)
        done = np.concatenate([opened[rows], np.ones((len(rows), more), bool)], 1)
        nodes[inverse, width + place], scores[inverse, width + place], done[inverse, width + place] = new_n, sims, False
        best = np.argsort(-scores, 1, kind="stable")[:, :width]
        beam[rows], score[rows], opened[rows] = (np.take_along_axis(x, best, 1) for x in (nodes, scores, done))
    # Range: open everything near the threshold until nothing near it is new.
    query, node, sims = np.concatenate(all_q), np.concatenate(all_n), np.concatenate(all_s)
    while len(query):
        good = sims >= p.threshold - 1e-4
        found_q.append(query[good])
        found_n.append(node[good])
        near = np.flatnonzero(sims >= p.threshold - p.slack)
        parts = [fresh(query[near[i : i + 20_000]], node[near[i : i + 20_000]]) for i in range(0, len(near), 20_000)]
        if not parts:
            break
        query, node, sims = (np.concatenate(x) for x in zip(*parts, strict=True))
    return np.concatenate(found_q), np.concatenate(found_n)


def verified(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Whether rows of doubles have at least this cosine."""
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) >= threshold


# ---------------------------------------------------------------- tasks


def _graph_task(p: GraphParams):
    """A part's vectors of bytes to each one's pruned neighbours."""

    def run(rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_numpy()
        order = np.argsort(ids)
        a, b = build_graph(_unit(_matrix(rows.column("small"))[order]).astype(np.float32), p)
        at = np.searchsorted(a, np.arange(len(ids) + 1)).astype(np.int32)
        near = pa.ListArray.from_arrays(pa.array(at), pa.array(ids[order][b]))
        return pa.table([pa.array(ids[order]), rows.column("cells").combine_chunks().take(pa.array(order)), near], ["id", "cells", "near"])

    return run


def _lowest_home(cell: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether ``cell`` is the lower one of the homes, which stand first."""
    return np.minimum(x[:, 0], y[:, 0]) == cell


def _lowest_common(cell: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether no cell below ``cell`` is in both rows of cells; both hold ``cell``, and rows are padded with -1 and -2."""
    lower = np.zeros(len(x), bool)
    for i in range(x.shape[1]):
        for j in range(y.shape[1]):
            lower |= (x[:, i] == y[:, j]) & (x[:, i] < cell) & (x[:, i] >= 0)
    return ~lower


def _padded(column, filler: int) -> np.ndarray:
    values, at = _lists(column)
    sizes = np.diff(at)
    out = np.full((len(sizes), int(sizes.max(initial=1))), filler, np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(at[:-1], sizes)] = values
    return out


def _pair_counts(out: list, ids_x, ids_y, copies_x, copies_y, x, y) -> None:
    """Adds counts for both ends and star-shaped edges of the pairs (x[i], y[i])."""
    if not len(x):
        return
    for ids, mine, others in ((ids_x, x, copies_y[y]), (ids_y, y, copies_x[x])):
        counts = np.bincount(mine, weights=others, minlength=len(ids)).astype(np.int64)
        some = np.flatnonzero(counts)
        out.append((np.zeros(len(some), np.int32), ids[some], counts[some]))
    nodes, roots = forest(ids_x[x], ids_y[y])
    out.append((np.ones(len(nodes), np.int32), nodes, roots))


def _table_of(out: list) -> pa.Table:
    out = out or [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["kind", "a", "b"])


def _compare(rows: pa.Table, p: GraphParams, near, owns) -> pa.Table:
    """Pairs between the sides of a task that belong here: ``near(nodes, unit)`` gives what proposes, the cosine in doubles decides."""
    side = rows.column("side").to_numpy()
    sides = [rows.take(pa.array(np.flatnonzero(side == s))) for s in (0, 1)]
    nodes = sides[0]
    if not nodes.num_rows:
        return _table_of([])
    same = not sides[1].num_rows  # one part, searched for in itself
    asks = nodes if same else sides[1]
    ids, copies, vectors = nodes.column("id").to_numpy(), nodes.column("copies").to_numpy(), _matrix(nodes.column("v")).astype(np.float64)
    own_ids, own_copies, own = (ids, copies, vectors) if same else (asks.column("id").to_numpy(), asks.column("copies").to_numpy(), _matrix(asks.column("v")).astype(np.float64))
    cells, own_cells = _padded(nodes.column("cells"), -1), _padded(asks.column("cells"), -2)
    unit = _unit(vectors).astype(np.float32)
    search, out, hits = near(nodes, unit), [], np.zeros((len(ids), len(ids)), bool) if same else None
    for lo in range(0, len(own_ids), 500):
        q, n = search(unit[lo : lo + 500] if same else _unit(own[lo : lo + 500]).astype(np.float32))
        q = q + lo
        if same:  # either end may find the pair
            hits[np.minimum(q, n), np.maximum(q, n)] = True
        else:
            _checked(out, ids, own_ids, copies, own_copies, vectors, own, cells, own_cells, n, q, owns, p)
    if same:
        np.fill_diagonal(hits, False)
        for lo in range(0, len(ids), 500):
            x, y = np.nonzero(hits[lo : lo + 500])
            _checked(out, ids, ids, copies, copies, vectors, vectors, cells, own_cells, x + lo, y, owns, p)
    return _table_of(out)


def _checked(out, ids, own_ids, copies, own_copies, vectors, own, cells, own_cells, x, y, owns, p) -> None:
    good = [np.zeros(0, bool)]
    for i in range(0, len(x), 20_000):
        a, b = x[i : i + 20_000], y[i : i + 20_000]
        good.append(verified(vectors[a], own[b], p.threshold) & owns(cells[a], own_cells[b]))
    good = np.concatenate(good)
    _pair_counts(out, ids, own_ids, copies, own_copies, x[good], y[good])


def _search_task(p: GraphParams):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, lists: pa.Table) -> pa.Table:
        def near(nodes: pa.Table, unit: np.ndarray):
            ids = nodes.column("id").to_numpy()
            order = np.argsort(ids)
            flat, at = _lists(lists.column("near"))
            owner = np.repeat(lists.column("id").to_numpy(), np.diff(at))

            def place(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                spot = np.minimum(np.searchsorted(ids[order], x), len(ids) - 1)
                return order[spot], ids[order[spot]] == x

            (a, in_a), (b, in_b) = place(owner), place(flat)
            here = in_a & in_b
            bounds, to = both_ways(a[here], b[here], len(ids))
            entry = medoids(unit)
            return lambda queries: range_search(unit, bounds, to, entry, queries, p)

        return _compare(rows, p, near, partial(_lowest_common, key[0].as_py()))

    return run


def _exact_task(p: GraphParams):
    """Every vector of a part against every other."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return _compare(rows, p, lambda nodes, unit: lambda queries: np.nonzero(queries @ unit.T >= p.threshold - 1e-4), partial(_lowest_home, key[0].as_py()))

    return run


# ---------------------------------------------------------------- cells


def _top(sims: np.ndarray, m: int) -> np.ndarray:
    return np.argsort(-sims, 1, kind="stable")[:, : min(m, sims.shape[1])]


def _nearest(centres: np.ndarray, overlap: int):
    """Adds ``cells``, the nearest centres' numbers, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                top = _top(_unit(_matrix(part.column("v"))).astype(np.float32) @ centres.T, overlap)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(len(top) + 1, dtype=np.int32) * top.shape[1]), pa.array(top.astype(np.int64).ravel()))
                yield pa.record_batch([*part.columns, cells], [*part.schema.names, "cells"])

    return run


def _kind(vectors: DataFrame) -> str:
    return vectors.schema["v"].dataType.simpleString()


def _fit(vectors: DataFrame, n: int, p: GraphParams) -> np.ndarray:
    sample = _matrix(vectors.orderBy(F.xxhash64("id"), "id").limit(p.sample).select("v").toArrow().column("v"))
    return clusters_of(sample, max(1, min(-(-n // p.leaf), p.fan, max(1, len(sample) // 8))), p.threshold)


def dealt_to_cells(vectors: DataFrame, p: GraphParams) -> DataFrame:
    """From (id, copies, v): adds ``cells``, the first one being the vector's home. One fit, or several below each other."""
    n = vectors.count()
    schema = f"id long, copies long, v {_kind(vectors)}, cells array<long>"
    dealt = vectors.select("id", "copies", "v").mapInArrow(_nearest(_fit(vectors, n, p), p.overlap), schema)
    if n <= p.fan * p.leaf:
        return dealt
    dealt = settle(dealt)
    for _ in range(p.levels - 1):
        split = _split(dealt, p)
        if split is None:
            break
        dealt = settle(vectors.join(split, "id"))
    return dealt


def _split(dealt: DataFrame, p: GraphParams) -> DataFrame | None:
    """(id, cells) after cells of far more than ``leaf`` vectors are dealt anew among centres of their own; None if there are none."""
    home = F.element_at("cells", 1)
    sizes = settle(dealt.groupBy(home.alias("cell")).agg(F.count("*").alias("n")).where(F.col("n") > 4 * p.leaf))
    if sizes.isEmpty():
        return None
    rows = dealt.select("id", "v", F.posexplode("cells").alias("rank", "cell")).join(sizes, "cell")
    # A bounded sample of each cell: the share is drawn by hash, so no task sorts the cell.
    share = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1_000_003)) < F.least(F.lit(1.0), F.lit(float(p.sample)) / F.col("n")) * 1_000_003

    def fit(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        wanted = max(1, min(-(-part.column("n")[0].as_py() // p.leaf), p.fan, part.num_rows // 8))
        centres = clusters_of(_matrix(part.column("v")), wanted, p.threshold)
        return pa.table([pa.array([key[0].as_py()]), pa.array([centres.ravel()])], ["cell", "centres"])

    fitted = settle(rows.where((F.col("rank") == 0) & share).select("cell", "n", "v").groupBy("cell").applyInArrow(fit, "cell long, centres array<float>"))
    # Cells are dealt in pieces of bounded size, each with a copy of its centres.
    pieces = F.ceil(F.col("n") / 20_000).cast("int")
    asks = rows.withColumn("piece", F.pmod(F.xxhash64("id"), pieces).cast("int")).select("cell", "piece", "id", "rank", "v")
    several = fitted.join(sizes, "cell").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces))).select("cell", "piece", "centres")

    def deal(key: tuple[pa.Scalar, ...], part: pa.Table, given: pa.Table) -> pa.Table:
        if not part.num_rows or not given.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.list_(pa.int64()))], ["id", "rank", "more"])
        vectors, rank = _matrix(part.column("v")), part.column("rank").to_numpy()
        centres = _matrix(given.column("centres")).astype(np.float32).reshape(-1, vectors.shape[1])
        top = _top(_unit(vectors).astype(np.float32) @ centres.T, p.overlap) + 1 + key[0].as_py() * (p.fan + 1)
        more = [row if r == 0 else row[:1] for row, r in zip(top, rank, strict=True)]  # of a neighbouring cell its nearest child only
        return pa.table([part.column("id"), part.column("rank"), pa.array(more, pa.list_(pa.int64()))], ["id", "rank", "more"])

    fresh = asks.groupBy("cell", "piece").cogroup(several.groupBy("cell", "piece")).applyInArrow(deal, "id long, rank int, more array<long>")
    same = dealt.select("id", F.posexplode("cells").alias("rank", "cell")).join(sizes, "cell", "left_anti").select("id", "rank", F.array(F.col("cell") * (p.fan + 1)).alias("more"))
    by_rank = F.sort_array(F.collect_list(F.struct("rank", "more")))
    return settle(fresh.unionByName(same).groupBy("id").agg(F.array_distinct(F.flatten(F.transform(by_rank, lambda x: x["more"]))).alias("cells")))


def _bounded_cells(dealt: DataFrame, centres: np.ndarray, p: GraphParams) -> DataFrame:
    """Cells in which the triangle inequality leaves room for a link; homes come from ``dealt``, cells being numbers of centres."""
    limit = float(np.arccos(p.threshold)) + 1e-6

    def angles(rows: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(_unit(rows) @ _unit(centres).T, -1, 1))

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.full(len(centres), -1.0)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                angle, home = angles(_matrix(part.column("v"))), _padded(part.column("cells"), -1)[:, 0]
                np.maximum.at(most, home, angle[np.arange(len(home)), home])
        yield pa.record_batch([pa.array(np.arange(len(centres))), pa.array(most)], ["cell", "radius"])

    radius = np.full(len(centres), -1.0)
    for r in dealt.select("v", "cells").mapInArrow(widest, "cell long, radius double").groupBy("cell").agg(F.max("radius").alias("radius")).collect():
        radius[r["cell"]] = r["radius"]  # one for each of at most `fan` centres

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                home = _padded(part.column("cells"), -1)[:, 0]
                into = (angles(_matrix(part.column("v"))) <= radius + limit) & (radius >= 0)
                into[np.arange(len(home)), home] = False
                cells = pa.array([np.append(own, np.flatnonzero(row)) for own, row in zip(home, into, strict=True)], pa.list_(pa.int64()))
                yield pa.record_batch([part.column("id"), part.column("copies"), part.column("v"), cells], ["id", "copies", "v", "cells"])

    return dealt.select("id", "copies", "v", "cells").mapInArrow(reach, f"id long, copies long, v {_kind(dealt)}, cells array<long>")


# ---------------------------------------------------------------- the search


def _parts(dealt: DataFrame, p: GraphParams) -> DataFrame:
    """(cell, parts) of the cells that need more than one part."""
    sizes = dealt.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    return settle(sizes.where(F.col("n") > p.part).select("cell", F.ceil(F.col("n") / p.part).cast("int").alias("parts")))


def _tasks(rows: DataFrame, parts: DataFrame, *columns: str) -> DataFrame:
    """Each row once for every two parts (x <= y) of its cells that hold it; side 0 holds the nodes (part y), side 1 asks."""
    parts_of, own = F.coalesce("parts", F.lit(1)), F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = rows.withColumn("cell", F.explode("cells")).join(parts, "cell", "left").select("cell", *columns, own.alias("own"), F.explode(F.sequence(F.lit(0), parts_of - 1)).alias("other"))
    return dealt.select("cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("other") > F.col("own")).cast("int").alias("side"), *columns)


_FOUND = "kind int, a long, b long"


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, cells, v): (id, cells, small) with one byte a component, the largest being 127."""
    for batch in batches:
        if batch.num_rows:
            v = _matrix(batch.column("v"))
            small = np.rint(v / np.abs(v).max(1, keepdims=True) * 127).astype(np.int8)
            bounds = pa.array(np.arange(len(small) + 1, dtype=np.int32) * small.shape[1])
            yield pa.record_batch([batch.column("id"), batch.column("cells"), pa.ListArray.from_arrays(bounds, pa.array(small.ravel()))], ["id", "cells", "small"])


def _search_all(vectors: DataFrame, p: GraphParams) -> tuple[DataFrame, DataFrame]:
    """Counts (id, n) of linked vectors and edges (a, b) among representatives."""
    dealt = dealt_to_cells(vectors, p)
    parts = _parts(dealt, p)
    own = F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int")
    small = dealt.select("id", "cells", "v").mapInArrow(_small, "id long, cells array<long>, small array<tinyint>")
    shards = small.withColumn("cell", F.explode("cells")).join(parts, "cell", "left").select("cell", own.alias("own"), "id", "cells", "small")
    lists = shards.groupBy("cell", "own").applyInArrow(_graph_task(p), "id long, cells array<long>, near array<long>")
    union = lists.groupBy("id").agg(F.first("cells").alias("cells"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    nodes = _tasks(union, parts, "id", "near").where("side = 0").groupBy("cell", "x", "y")
    asks = _tasks(dealt, parts, "id", "copies", "v", "cells").groupBy("cell", "x", "y")
    return _counts_and_edges(settle(asks.cogroup(nodes).applyInArrow(_search_task(p), _FOUND)))


def _search_exactly(vectors: DataFrame, p: GraphParams) -> tuple[DataFrame, DataFrame]:
    """The same by bounds alone, nothing lost: the way that is left when graphs fall short."""
    centres = _fit(vectors, vectors.count(), p)
    dealt = settle(vectors.select("id", "copies", "v").mapInArrow(_nearest(centres, 1), f"id long, copies long, v {_kind(vectors)}, cells array<long>"))
    dealt = settle(_bounded_cells(dealt, centres, p))
    rows = _tasks(dealt, _parts(dealt, p), "id", "copies", "v", "cells")
    return _counts_and_edges(settle(rows.groupBy("cell", "x", "y").applyInArrow(_exact_task(p), _FOUND)))


def _counts_and_edges(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    counts = found.where("kind = 0").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("n"))
    return counts, found.where("kind = 1 and a <> b").select("a", "b")


def audit(vectors: DataFrame, found: DataFrame, p: GraphParams) -> float:
    """Share of true links of ``audit`` queries (lowest hashes of ids) that ``found`` (id, n) counts; brute force in blocks.

    The lesser of the share of all links and the queries' average share, so that one large group does not hide small ones.
    """
    asks = vectors.orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(p.audit).select("id", "v").toArrow()
    if not asks.num_rows:
        return 1.0
    ids, own = asks.column("id").to_numpy(), _matrix(asks.column("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, total = _unit(own), np.zeros(len(ids), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                hit = (mine @ _unit(_matrix(part.column("v"))).T >= p.threshold) & (ids[:, None] != part.column("id").to_numpy()[None])
                total += hit.astype(np.int64) @ part.column("copies").to_numpy()
        yield pa.record_batch([pa.array(ids), pa.array(total)], ["id", "true"])

    true = vectors.select("id", "v", "copies").mapInArrow(run, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
    n = F.coalesce("n", F.lit(0))
    both = true.join(found, "id", "left").where(F.col("true") > 0).agg(F.sum("true").alias("t"), F.sum(n).alias("f"), F.avg(n / F.col("true")).alias("mean")).first()
    return 1.0 if not both["t"] else min(both["f"] / both["t"], both["mean"])


def _audited(vectors: DataFrame, p: GraphParams) -> tuple[DataFrame, DataFrame]:
    """Counts and edges of vectors of one length, searched ever wider until the audit is content, exactly after that."""
    for _ in range(p.tries):
        counts, edges = _search_all(vectors, p)
        if audit(vectors, counts, p) >= p.recall:
            return counts, edges
        p = replace(p, overlap=p.overlap * 2, beam=p.beam * 2, starts=p.starts * 2, degree=p.degree * 2)
    counts, edges = _search_exactly(vectors, p)
    reached = audit(vectors, counts, p)
    if reached < LEAST_RECALL:
        raise RuntimeError(f"recall of embedding links is {reached:.3f}, below {LEAST_RECALL}")
    return counts, edges


def _vectors(table: DataFrame, rows: DataFrame, folded: DataFrame, v: Column) -> DataFrame:
    """(id, copies, v) of one row for each distinct vector."""
    leads = folded.select("id", "copies", "h1", "h2")
    hashed = table.where("vec_id is not null").select(F.col("vec_id").alias("id"), v.alias("v")).where("v is not null")
    if not rows.where("rows > 1").isEmpty():
        hashed = hashed.withColumns({"g1": F.xxhash64("v"), "g2": F.xxhash64(F.lit(9), "v")})
        return hashed.join(leads, "id").where("g1 = h1 and g2 = h2").select("id", "copies", "v").dropDuplicates(["id"])
    many = folded.where("copies > 1").select("h1", "h2", "id", "copies")
    # Most vectors stand alone: only copies need a mark, and a small side of marks moves, not the vectors.
    copies = settle(rows.where("h1 is not null").join(many, ["h1", "h2"]).select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") == F.col("id"), F.col("copies")).otherwise(0).alias("copies")))
    if copies.isEmpty():
        return hashed.select("id", F.lit(1).cast("long").alias("copies"), "v")
    return hashed.join(copies, "id", "left").select("id", F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), "v").where("copies > 0")


def embedding_groups(table: DataFrame, params: GraphParams = GraphParams()) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each id."""
    p = params
    single = isinstance(table.schema["embedding"].dataType.elementType, FloatType)
    values = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.coalesce((F.size(values) > 0) & ~odd & F.exists(values, lambda x: x != 0), F.lit(False))
    v = F.when(sound, values)
    digest = F.when(sound, F.struct(F.xxhash64(values).alias("h1"), F.xxhash64(F.lit(9), values).alias("h2"), F.size(values).alias("d")))
    rows = table.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), digest.alias("s")).groupBy("vec_id").agg(F.min("s").alias("s"), F.count("*").alias("rows"))
    rows = settle(rows.select("vec_id", "s.*", "rows"))
    lengths = {r["d"]: r["count"] for r in rows.where("h1 is not null").groupBy("d").count().orderBy(F.desc("count"), "d").collect()}
    if not lengths:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    folded = settle(rows.where("h1 is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    vectors = _vectors(table, rows, folded, v)
    # A graph for the commonest length and for every other with many vectors; the rest is compared whole.
    large = [d for i, (d, n) in enumerate(lengths.items()) if i == 0 or n > p.part]
    found = [_audited(vectors if len(lengths) == 1 else vectors.where(F.size("v") == d), p) for d in large]
    if len(large) < len(lengths):
        rest = vectors.where(~F.size("v").isin(large)).select(F.size("v").cast("long").alias("cell"), F.lit(0).alias("side"), "id", "copies", "v", F.array(F.size("v").cast("long")).alias("cells"))
        found.append(_counts_and_edges(settle(rest.groupBy("cell").applyInArrow(_exact_task(p), _FOUND))))
    counts, edges = (reduce(DataFrame.unionByName, x) for x in zip(*found, strict=True))
    groups = components(edges)
    per_vector = folded.join(counts, "id", "left").join(groups.withColumnRenamed("component", "comp"), "id", "left").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("comp", "id").alias("comp")
    )
    out = rows.join(per_vector, ["h1", "h2"], "left")
    component = F.coalesce("comp", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
