"""Toxicity, quality classifier and quality rules: accuracy on held-out rows, base counts against brute force, odd inputs."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kotonoha.llm import quality_model, quality_rules, toxicity

ODD = ["", None, "a", "  \n\n ", "x y\nx y\n", "a b c d e f g h a b c d e f g h", "ü" * 50, "<|endoftext|>", "word " * 30_000, "\x00\x0b\x0c\x1f"]


def held(rows, modulus, remainder):
    return [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder]


@pytest.mark.parametrize(
    "run, label, modulus, remainder, least",
    [(quality_model.quality_scores, "quality", 5, 0, 0.9), (toxicity.toxicity_scores, "toxic", 4, 2, 0.8)],
)
def test_held_out_accuracy(spark, run, label, modulus, remainder, least):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = run(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder)
    own = [r for r in rows if r["held_out"] and r[label] is not None]
    assert np.mean([r["predicted"] == r[label] for r in own]) >= least


@pytest.mark.parametrize("run", [quality_model.quality_scores, toxicity.toxicity_scores, quality_rules.quality_rules])
def test_odd_texts_and_clashing_columns(spark, docs_of, labels, run):
    docs = docs_of(ODD).selectExpr("*", "1 AS score", "2 AS quality", "3 AS toxic", "4 AS _label", "5 AS held_out")
    assert run(docs, labels).count() == len(ODD)
    assert run(docs.union(docs), labels).count() == 2 * len(ODD)
    assert run(docs.limit(0), labels).count() == 0
    assert run(docs, labels.limit(0)).count() == len(ODD)


def test_subwords_carry_to_misspellings():
    words = ["the", "of", "and", "reading", "house", "river"]
    rng = np.random.default_rng(0)
    clean = [" ".join(rng.choice(words, 30)) for _ in range(150)]
    toxic = [" ".join([*rng.choice(words, 15), rng.choice(["worthless", "disgusting"]), *rng.choice(words, 15)]) for _ in range(50)]
    model = toxicity.fit(clean + toxic, np.array([0] * 150 + [1] * 50, float))
    odd, plain = model.score(pa.array(["the river of worthles and house", "the river of reading and house"]))
    assert odd > 0.3 > plain


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    cover = {i + j for i, x in enumerate(windows) if counts[x] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)


def test_base_counts_against_brute_force(spark, docs_of, documents, labels):
    texts = ODD + [r["text"] for r in documents.select("text").collect()] + ["l\nl\n \nl", "\n", "a\n\na"]
    rows = quality_rules.quality_rules(docs_of(texts), labels).collect()
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality_rules.BASE) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_trees_keep_the_demanded_order():
    rng = np.random.default_rng(1)
    x = rng.random((600, 2))
    y = ((x[:, 0] + 0.3 * rng.random(600)) < 0.6).astype(float)
    trees = quality_rules.fit(x, y, signs=(-1, 0))
    grid = np.linspace(0, 1, 60)
    for other in (0.1, 0.5, 0.9):
        score = trees.score(np.stack([grid, np.full(60, other)], 1))
        assert (np.diff(score) <= 1e-12).all()
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.85
