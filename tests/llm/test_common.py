"""Shared helpers: places in a total order, settled tables, byte kernels."""

import pytest

import re

import numpy as np
import pyarrow as pa

from kotonoha.llm import bytewords as bw
from kotonoha.llm import common


def test_ranked_with_one_hot_value(spark):
    df = spark.range(0, 4000).selectExpr("IF(id % 3 = 0, 7, id % 50) AS k", "id", "id % 5 AS again").repartition(6)
    rows = sorted(common.ranked(df, "k", "again", "id").collect(), key=lambda r: r["pos"])
    assert [r["pos"] for r in rows] == list(range(4000))
    assert [(r["k"], r["again"], r["id"]) for r in rows] == sorted((r["k"], r["again"], r["id"]) for r in rows)
    assert common.ranked(df.limit(0), "k", "id").count() == 0


def test_settled_tables(spark):
    df = spark.range(100).selectExpr("id", "CAST(NULL AS string) AS s", "array(id) AS a")
    assert common.settle(df).schema.simpleString() == df.schema.simpleString() and common.settle(df).count() == 100
    kept = common.settle_by(df.repartition("id"), "id")
    plan = kept.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 100 and "hashpartitioning" not in plan and not [t for t in spark.catalog.listTables() if t.name.startswith("kotonoha_")]


def test_words_and_hashes():
    texts = ["a bb  ccc", None, "", "é x\ty", "bb", "\n"]
    (block,) = bw.blocks(pa.array(texts))
    starts, ends, first = bw.words(block, bw.SPACES)
    found = [[bytes(block.data[s:e]) for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    hashes = bw.span_hash(bw.prefix_hash(block.data), starts, ends)
    assert hashes[1] == hashes[first[4]] and len(set(hashes.tolist())) == len(hashes) - 1


def test_blocks_hold_whole_texts():
    column = pa.chunked_array([pa.array(["x" * n for n in (5, 0, 900, 3, 2000, 1)])])
    sizes = [(b.lo, b.hi, len(b.data)) for b in bw.blocks(column, 1000)]
    assert [s[0] for s in sizes] == [0] + [s[1] for s in sizes[:-1]] and sizes[-1][1] == 6 and sum(s[2] for s in sizes) == 2909
    assert list(bw.blocks(pa.array([], pa.string()))) == []


def test_shingles_against_sets():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "B", "c", "dd"], n)) for n in range(40)]
    (block,) = bw.blocks(pa.array(texts))
    found, at = bw.shingles(block)
    for i, t in enumerate(texts):
        ws = t.lower().split()
        want = {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())
        assert at[i + 1] - at[i] == len(want)


def test_a_cluster_needs_a_shared_folder_and_jobs_clean_up(spark):
    from types import SimpleNamespace

    none = SimpleNamespace(isEmpty=lambda: True)
    context = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))
    table = common.settle(spark.range(5))
    assert table.count() == 5
    common.clean_up(spark)
    with pytest.raises(Exception):
        table.count()
