"""Ranked lexical search over documents that recursive graph bisection has put in order, visited shard by shard.

Documents that hold the same query terms are brought together first. Recursive bisection of the graph of documents and terms
is fitted on a bounded sample: a node splits its documents into halves, and pairs of documents change sides while that
makes the terms' postings cheaper to write (the logarithms of their gaps). What is left of each node is how strongly a
term pulls to either side; every document of the corpus then walks down the tree by its own terms, and documents are dealt
by ranges of (leaf, id). Runs of ``shard`` documents make the shards of a clustered index: postings with each term's
contribution already computed, and its largest one in the shard.

A query's bound in a shard is the sum of its terms' weights times these maxima. Shards are visited best bound first, in
rounds: after a round each query knows the score that ``top`` documents have reached, and only shards whose bound is no
lower can still change its answer. The last round visits all of those, so the answer is exact. Equal scores are ranked by
doc_id, whatever place the order gave a document; a shard whose bound equals the reached score is visited too.

Only terms that queries hold are indexed. Queries are worked on in blocks of ``terms`` distinct terms at most (or one query
that alone holds more), so what is broadcast is bounded. No task sees more than a shard, or the best few of each shard for a query.

Defined cases: a null or empty text has no terms and is not counted; a query without terms, or whose terms no document
holds, has no rows; repeated rows are documents of their own, as are rows with a null id, which come after all ids of the
same score; queries that repeat an item_id are answered each; texts of any length are read whole; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import arrays, sample_of, settle


@dataclass(frozen=True)
class SearchParams:
    top: int = 50
    shard: int = 1024  # documents of a shard
    sample: int = 8000  # documents that the bisection is fitted on
    depth: int = 7  # of the tree
    least: int = 16  # documents of a node that is split
    swaps: int = 12  # most rounds of swaps in a node
    slots: int = 4096  # in which the tree's nodes keep terms
    terms: int = 200_000  # distinct terms of a block of queries
    visits: tuple[int, ...] = (2, 8)  # shards that a query visits in the rounds before the last


# ---------------------------------------------------------------- terms and their numbers


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's distinct terms, as hashes."""
    for batch in batches:
        for block in bw.blocks(arrays(batch, "text")):
            starts, ends, first = bw.words(block, bw.TERMS)
            hashes = bw.hash_spans(bw.LOWER[block.data], starts, ends).view(np.int64)
            own = arrays(batch, "item_id").slice(block.lo, len(block.at) - 1)
            lists = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.record_batch([own, pa.array(lists, pa.list_(pa.int64()))], ["item_id", "terms"])


@dataclass
class Queries:
    """A block of queries: their ids, and the numbers of their terms in the sorted ``vocabulary``, query after query."""

    items: list
    vocabulary: np.ndarray
    term: np.ndarray
    at: np.ndarray


def _query_blocks(items: DataFrame, p: SearchParams) -> Iterator[Queries]:
    kind = items.schema["item_id"].dataType.simpleString()
    rows = settle(items.select("item_id", "text").mapInArrow(_item_terms, f"item_id {kind}, terms array<long>").where(F.size("terms") > 0))
    total = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // p.terms)
    for number in range(blocks):
        mine = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == number)
        found = mine.toArrow()
        if not found.num_rows:
            continue
        lists = found.column("terms").combine_chunks()
        every = lists.flatten().to_numpy().view(np.uint64)
        vocabulary = np.unique(every)
        at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        yield Queries(found.column("item_id").to_pylist(), vocabulary, np.searchsorted(vocabulary, every), at)


def _document_terms(held):
    """Per document with query terms (kind 0): its length, and numbers and counts of these terms; per task (kind 1): how many
    documents it saw, their lengths in all, and how many of them hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held.value
        df, documents, length, seen = np.zeros(len(vocabulary), np.int64), 0, 0, 0
        names = ["kind", "doc_id", "row", "n", "total", "terms", "counts"]
        kind_of_id = None
        for batch in batches:
            own = arrays(batch, "doc_id")
            kind_of_id = own.type
            for block in bw.blocks(arrays(batch, "text")):
                starts, ends, first = bw.words(block, bw.TERMS)
                hashes = bw.hash_spans(bw.LOWER[block.data], starts, ends)
                n = np.diff(first)
                documents, length = documents + int((n > 0).sum()), length + int(n.sum())
                number = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                hit = np.flatnonzero(vocabulary[number] == hashes)
                owner = np.repeat(np.arange(len(n)), n)[hit]
                code, counts = np.unique(owner * len(vocabulary) + number[hit], return_counts=True)
                text, term = code // len(vocabulary), (code % len(vocabulary)).astype(np.int32)
                df += np.bincount(term, minlength=len(df))
                with_terms = np.unique(text)
                bounds = pa.array(np.append(np.searchsorted(text, with_terms), len(text)).astype(np.int32))
                yield pa.record_batch([
                    pa.array(np.zeros(len(with_terms), np.int32)), own.take(pa.array(block.lo + with_terms)), pa.array(seen + with_terms), pa.array(n[with_terms]), pa.nulls(len(with_terms), pa.int64()),
                    pa.ListArray.from_arrays(bounds, pa.array(term)), pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32))),
                ], names)
                seen += len(n)
        if documents:
            term = np.flatnonzero(df)
            lists = [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (term, df[term])]
            yield pa.record_batch([pa.array([1], pa.int32()), pa.nulls(1, kind_of_id), pa.array([0]), pa.array([documents]), pa.array([length]), *lists], names)

    return run


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# ---------------------------------------------------------------- recursive graph bisection


def _pull(one: np.ndarray, two: np.ndarray, n_one: int, n_two: int) -> np.ndarray:
    """By slot: how many bits of gaps are saved when a document that holds the term goes from the second half to the first."""

    def cost(degree: np.ndarray, n: int) -> np.ndarray:
        return degree * np.log2(max(n, 1) / (degree + 1.0))

    return (cost(one, n_one) + cost(two, n_two)) - (cost(one + 1, n_one) + cost(np.maximum(two - 1, 0), n_two))


@dataclass
class Bisection:
    """A tree of ``depth`` levels as a heap: pulls of each node's slots and the value from which a document goes to the first half."""

    depth: int
    slots: int
    pulls: np.ndarray
    limits: np.ndarray

    def leaves(self, term: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The leaf that each document reaches, 0 to 2**depth - 1."""
        node, owner, slot = np.zeros(len(at) - 1, np.int64), np.repeat(np.arange(len(at) - 1), np.diff(at)), term % self.slots
        for _ in range(self.depth):
            value = np.bincount(owner, weights=self.pulls[node[owner], slot], minlength=len(node))
            node = 2 * node + 1 + (value < self.limits[node])
        return node - (2**self.depth - 1)


def fit_bisection(term: np.ndarray, at: np.ndarray, p: SearchParams) -> Bisection:
    """Fits the tree on documents given as runs of term numbers; nodes with fewer than ``least`` of them split nothing."""
    n_nodes = 2**p.depth - 1
    tree = Bisection(p.depth, p.slots, np.zeros((n_nodes, p.slots), np.float32), np.zeros(n_nodes))
    slot, sizes = term % p.slots, np.diff(at)
    todo = [(0, np.arange(len(sizes)))]
    while todo:
        node, docs = todo.pop()
        if len(docs) < p.least or node >= n_nodes:
            continue
        mine = bw.ranges(at[docs], at[docs + 1])
        own, local = slot[mine], np.repeat(np.arange(len(docs)), sizes[docs])
        first = np.arange(len(docs)) < len(docs) // 2
        for _ in range(p.swaps):
            one = np.bincount(own[first[local]], minlength=p.slots)
            two = np.bincount(own[~first[local]], minlength=p.slots)
            n_one = int(first.sum())
            to_one = np.bincount(local, weights=_pull(one, two, n_one, len(docs) - n_one)[own], minlength=len(docs))
            to_two = np.bincount(local, weights=_pull(two, one, len(docs) - n_one, n_one)[own], minlength=len(docs))
            a, b = np.flatnonzero(first), np.flatnonzero(~first)
            a, b = a[np.argsort(-to_two[a], kind="stable")], b[np.argsort(-to_one[b], kind="stable")]
            k = min(len(a), len(b))
            swap = np.flatnonzero(to_two[a[:k]] + to_one[b[:k]] > 1e-9)
            if not len(swap):
                break
            first[a[swap]], first[b[swap]] = False, True
        one, two = np.bincount(own[first[local]], minlength=p.slots), np.bincount(own[~first[local]], minlength=p.slots)
        pull = np.log2((one + 1.0) / max(1, int(first.sum()))) - np.log2((two + 1.0) / max(1, int((~first).sum())))
        pull = np.where(one + two > 0, pull, 0).astype(np.float32)
        value = np.bincount(local, weights=pull[own], minlength=len(docs))
        tree.pulls[node], tree.limits[node] = pull, np.median(value)
        goes = value >= tree.limits[node]
        todo += [(2 * node + 1, docs[goes]), (2 * node + 2, docs[~goes])]
    return tree


def _with_leaves(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("terms"))
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            leaf = tree.value.leaves(lists.flatten().to_numpy(), at)
            yield pa.record_batch([*batch.columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    return run


# ---------------------------------------------------------------- shards


def _shards(p: SearchParams, documents: int, length: int):
    """From a task's documents in order: one row for each run of ``shard`` of them, with postings and maxima by term."""

    def packed(rows: pa.Table) -> pa.RecordBatch:
        terms, counts = (rows.column(c).combine_chunks() for c in ("terms", "counts"))
        local = np.repeat(np.arange(rows.num_rows, dtype=np.int32), terms.value_lengths().to_numpy())
        term, tf, n = terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64), rows.column("n").to_numpy()
        # Whole numbers of any size here, so that the product of three large ones is exact.
        m = np.array([50 + (50 * x * documents) // length for x in n.tolist()], np.int64)
        share = (1_000_000_000 * tf) // (1000 * tf + 20 * m[local])
        order = np.argsort(term, kind="stable")
        term, local, share = term[order], local[order], share[order]
        own, first = np.unique(term, return_index=True)
        blobs = [own.astype("<i4"), np.append(first, len(term)).astype("<i4"), local.astype("<i4"), share.astype("<i4"), np.maximum.reduceat(share, first).astype("<i4")]
        ids = pa.array([rows.column("doc_id").to_pylist()], pa.list_(rows.schema.field("doc_id").type))
        rest = [pa.array([rows.column("row").to_pylist()], pa.list_(pa.int64())), *[pa.array([x.tobytes()], pa.binary()) for x in blobs]]
        return pa.record_batch([ids, *rest], ["ids", "rows", "terms", "starts", "places", "shares", "most"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, p.shard - n)
                held.append(part)
                n, at = n + part.num_rows, at + part.num_rows
                if n == p.shard:
                    yield packed(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield packed(pa.Table.from_batches(held))

    return run


def _bounds(held):
    """The bound of each query in each shard, where it is above 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = held.value
        for batch in batches:
            for shard, terms, most in zip(*[arrays(batch, c).to_pylist() for c in ("shard", "terms", "most")], strict=True):
                best = np.zeros(len(weights), np.int64)
                terms = np.frombuffer(terms, "<i4")
                best[terms] = weights[terms] * np.frombuffer(most, "<i4").astype(np.int64)
                bound = np.add.reduceat(best[queries.term], queries.at[:-1])
                q = np.flatnonzero(bound > 0)
                yield pa.record_batch([pa.array(np.full(len(q), shard)), pa.array(q.astype(np.int32)), pa.array(bound[q])], ["shard", "query", "bound"])

    return run


def _visited(held, p: SearchParams):
    """From shards with the queries that visit them (and what these have reached): each query's best documents there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = held.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: column[i] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                ids, rows = row["ids"].values, np.array(row["rows"].as_py())
                own, starts, places, shares = (np.frombuffer(row[c].as_py(), "<i4") for c in ("terms", "starts", "places", "shares"))
                void = ids.is_null().to_numpy(zero_copy_only=False)
                order_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
                for visit in row["visits"].as_py():
                    q = visit["query"]
                    term = queries.term[queries.at[q] : queries.at[q + 1]]
                    where = np.minimum(np.searchsorted(own, term), len(own) - 1)
                    there = own[where] == term
                    score = np.zeros(len(ids), np.int64)
                    for t, k in zip(term[there].tolist(), where[there].tolist(), strict=True):
                        score[places[starts[k] : starts[k + 1]]] += weights[t] * shares[starts[k] : starts[k + 1]].astype(np.int64)
                    good = np.flatnonzero((score > 0) & (score >= visit["reached"]))
                    good = good[np.lexsort((rows[good], order_id[good], void[good], -score[good]))[: p.top]]
                    yield pa.record_batch([pa.array(np.full(len(good), q, np.int32)), ids.take(pa.array(good)), pa.array(rows[good]), pa.array(score[good])], ["query", "doc_id", "row", "score"])

    return run


def _best(found: DataFrame, p: SearchParams) -> DataFrame:
    """Each query's ``top`` best rows with their rank. Tasks keep only their own best before anything moves."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.top)


# ---------------------------------------------------------------- the operator


def lexical_search(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): for each row of ``items`` the highest-scoring rows of ``docs``."""
    spark = docs.sparkSession
    item, doc = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item}, rank int, doc_id {doc}, score long")
    for queries in _query_blocks(items, params):
        names = spark.createDataFrame([(i, x) for i, x in enumerate(queries.items)], f"query int, item_id {item}")
        found = _searched(docs, queries, params).join(F.broadcast(names), "query")
        out = out.unionByName(found.select("item_id", "rank", "doc_id", "score"))
    return out


def _searched(docs: DataFrame, queries: Queries, p: SearchParams) -> DataFrame:
    spark, doc = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    vocabulary = spark.sparkContext.broadcast(queries.vocabulary)
    schema = f"kind int, doc_id {doc}, row long, n long, total long, terms array<int>, counts array<int>"
    found = settle(docs.select("doc_id", "text").mapInArrow(_document_terms(vocabulary), schema))
    tasks, rows = found.where("kind = 1"), found.where("kind = 0").select("doc_id", "row", "n", "terms", "counts")
    facts = tasks.agg(F.sum("n").alias("documents"), F.sum("total").alias("length")).first()
    documents, length = facts["documents"] or 0, facts["length"] or 0
    held = tasks.select(F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("n")))).groupBy("term").agg(F.sum("n").alias("df")).toArrow()
    df = np.zeros(len(queries.vocabulary), np.int64)
    df[held.column("term").to_numpy()] = held.column("df").to_numpy()
    weights = np.array([term_weight(documents, x) for x in df.tolist()], np.int64)

    sample = sample_of(rows.select("terms", F.xxhash64("doc_id", "terms").alias("key")), "key", p.sample).toArrow().column("terms").combine_chunks()
    tree = spark.sparkContext.broadcast(fit_bisection(sample.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sample.value_lengths().to_numpy()))), p))
    ordered = (
        rows.mapInArrow(_with_leaves(tree), f"doc_id {doc}, row long, n long, terms array<int>, counts array<int>, leaf int")
        .repartitionByRange("leaf", "doc_id", "row").sortWithinPartitions("leaf", "doc_id", "row")
    )
    schema = f"ids array<{doc}>, rows array<long>, terms binary, starts binary, places binary, shares binary, most binary"
    index = settle(ordered.mapInArrow(_shards(p, documents, max(length, 1)), schema).withColumn("shard", F.monotonically_increasing_id()))

    both = spark.sparkContext.broadcast((queries, weights))
    bounds = settle(index.select("shard", "terms", "most").mapInArrow(_bounds(both), "shard long, query int, bound long"))
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "shard")
    best, todo = None, bounds
    for most in (*p.visits, None):
        if best is None:
            open_ = todo.withColumn("reached", F.lit(0).cast("long"))
        else:
            # A query that has `top` documents goes on only where the bound is not below the last one's score.
            reached = best.where(F.col("rank") == p.top).select("query", F.col("score").alias("reached"))
            open_ = todo.join(F.broadcast(reached), "query", "left").withColumn("reached", F.coalesce("reached", F.lit(0))).where("bound >= reached")
        if most is not None:
            open_ = open_.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
        now = settle(open_.select("shard", "query", "reached"))
        visits = now.groupBy("shard").agg(F.collect_list(F.struct("query", "reached")).alias("visits"))
        seen = index.select("shard", "ids", "rows", "terms", "starts", "places", "shares").join(visits, "shard")
        seen = seen.mapInArrow(_visited(both, p), f"query int, doc_id {doc}, row long, score long")
        best = settle(_best(seen if best is None else seen.unionByName(best.drop("rank")), p))
        todo = todo.join(now.select("shard", "query"), ["shard", "query"], "left_anti")
    return best


#: The same in DuckDB: every document that holds a term of an item is scored.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), q AS (
  SELECT DISTINCT i, item_id, term FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
), totals AS (
  SELECT count(*) FILTER (len(ws) > 0) AS n_all, sum(len(ws))::BIGINT AS l_all FROM d
), p AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), totals
), s AS (
  SELECT q.i, q.item_id, p.r, p.doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_all) // l_all))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), totals GROUP BY q.i, q.item_id, p.r, p.doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0
) WHERE rank <= 50
"""

__all__ = ["ORACLE_SQL", "SearchParams", "fit_bisection", "lexical_search", "term_weight"]
