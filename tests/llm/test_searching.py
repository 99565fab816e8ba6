"""License scan, lexical search and importance resampling against brute force and their SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from kotonoha.llm import importance, lexical_search, license_scan
from kotonoha.llm.queries import ORACLE_SQL, QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_lexical_search"])
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, FOLDER)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.execute(ORACLE_SQL[name]).fetchall()
    assert rows_of(got.select(*[c[0] for c in con.description])) == sorted((tuple(r) for r in want), key=repr)


# ---------------------------------------------------------------- license scan


def scanned(text, templates):
    """Brute force: words against templates, place by place."""
    ws, base, labels, places, score = words(text), set(), set(), [], 0.0
    for t in templates:
        tw = t.words
        hits = {}
        for i in range(len(ws) - 2):
            for k in range(len(tw) - 2):
                if ws[i : i + 3] == tw[k : k + 3]:
                    hits.setdefault(i - k, set()).add(k)
        for d in hits:
            if t.base:
                if ws[d : d + len(tw)] == tw and d >= 0:
                    base.add(t.label)
                    places.append(d)
                    score = 1.0
                continue
            covered = {k + j for e in range(d, d + license_scan.DRIFT + 1) for k in hits.get(e, ()) for j in range(3)}
            score = max(score, len(covered) / len(tw))
            if len(covered) >= -(-len(tw) * round(100 * t.share) // 100):
                labels.add(t.label)
    return (len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score)


def test_license_scan_against_brute_force(spark, docs_of):
    rng = random.Random(5)
    plain = ["the", "of", "a", "license", "software", "mit", "under", "cc", "by", "nc", "permission", "to"]
    texts = [None, "", " .,;", "MIT", "under the", "Under the MIT License.", "cc-by-nc CC BY-NC 4.0", "cc by nc by nc cc by nc", "Apache License, Version 2.0!", "é cc BY　nc", "ÉCC by nc"]
    texts += ["under the mit license " * 3000, "x " * 5000 + "gnu general public license version 3"]
    for t in license_scan.TEMPLATES[3:]:
        ws = t.words
        for changes in (0, 2, 5, 12, 25):
            mine = list(ws)
            for _ in range(changes):
                at = rng.randrange(len(mine) + 1)
                mine[at : at + rng.randint(0, 2)] = [rng.choice(plain)] * rng.randint(0, 2)
            texts.append(" ".join(rng.choices(plain, k=rng.randint(0, 30)) + mine + rng.choices(plain, k=5)).upper())
    texts += [" ".join(rng.choices(plain, k=200)) for _ in range(20)]
    got = {r["doc_id"]: tuple(r)[1:8] for r in license_scan.license_scan(docs_of(texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == scanned(text, license_scan.TEMPLATES), text
    assert got[7][1:4] == (2, 0, 5) and got[6][1] == 2 and got[11][1:4] == (3000, 0, 4 * 2999)
    labels = Counter(x for r in got.values() for x in r[5].split(",") if x)
    assert {"mit", "isc", "bsd", "gpl-3", "mpl-2", "zlib", "unlicense"} <= set(labels)


def test_license_spans_hold_the_copy(spark, docs_of):
    notice = license_scan.TEMPLATES[3].text.split()
    text = " ".join(["filler"] * 40 + notice[:20] + ["extra", "words"] + notice[20:] + ["filler"] * 40)
    (row,) = license_scan.license_scan(docs_of([text])).collect()
    assert row["labels"] == "mit" and row["base_labels"] == "" and row["score"] == 1.0
    assert min(s["first_word"] for s in row["spans"]) == 40 and max(s["last_word"] for s in row["spans"]) == 40 + len(notice) + 1


def test_license_scan_odd_tables(spark):
    rows = [(None, "under the mit license", "x"), (None, "under the mit license", "y"), (3, "cc by nc", "a"), (3, "cc by nc", "b"), (3, None, "c"), (3, "other", "d")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, label string, template int, _h int")
    got = Counter((r["doc_id"], r["n_base"], r["labels"]) for r in license_scan.license_scan(docs).collect())
    assert got == {(None, 1, "mit"): 2, (3, 1, "cc-by-nc"): 2, (3, 0, ""): 2}
    assert license_scan.license_scan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan.license_scan(docs, (license_scan.Template("x", "two words"),))


def test_templates_beyond_the_broadcast_are_joined_by_shuffle(spark, docs_of, monkeypatch):
    texts = ["under the mit license", "nothing", None, "cc by nc"]
    want = rows_of(license_scan.license_scan(docs_of(texts)))
    monkeypatch.setattr(license_scan, "BROADCAST_GRAMS", 10)
    assert rows_of(license_scan.license_scan(docs_of(texts))) == want


def test_license_scan_is_native(spark, docs_of):
    plan = license_scan.license_scan(docs_of(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- lexical search


def searched(docs, items, top=50):
    """Brute force over rows (doc_id, text) and (item_id, text)."""
    held = [(i, r, Counter(words(t))) for r, (i, t) in enumerate(docs)]
    n_all, l_all = sum(bool(c) for *_, c in held), sum(sum(c.values()) for *_, c in held)
    df = Counter(t for *_, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, r, c in held:
            n = sum(c.values())
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * (50 + (50 * n * n_all) // l_all)))
                for t in set(words(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, r, i))
        out += [(item, k, s[4], -s[0]) for k, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed, n, repeats=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Straße", "é", "日本"]
    topics = [rng.sample(vocabulary, 25) for _ in range(8)]
    texts = [" ".join(rng.choices(rng.choice(topics), k=rng.randint(1, 40)) + rng.choices(vocabulary, k=rng.randint(0, 10))) for _ in range(n)]
    return [t for t in texts for _ in range(repeats)], [" ".join(rng.choices(rng.choice(topics), k=rng.randint(1, 12))) for _ in range(12)]


@pytest.mark.parametrize("params", [lexical_search.SearchParams(), lexical_search.SearchParams(top=5, shard=16, depth=5, visits=(1, 3)), lexical_search.SearchParams(top=3, shard=7, depth=3, sample=50, slots=16, terms=20, visits=(1,))])
def test_search_against_brute_force(spark, params):
    texts, queries = corpus(11, 300, 2)
    docs = [(i * 37 % 1009, t) for i, t in enumerate(texts)] + [(5000, None), (5001, ""), (5002, "...")]
    items = list(enumerate(queries)) + [(90, None), (91, "nowhere to be found"), (92, ""), (0, queries[1])]
    got = lexical_search.lexical_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), params)
    assert rows_of(got) == searched(docs, items, params.top)


def test_search_ties_nulls_and_repeats(spark):
    docs = [(7, "same words here"), (None, "same words here"), (7, "same words here"), (3, "same words here"), (None, "same words here"), (1, "x " * 50_000 + "same")]
    docs += [(100 + i, "filler text") for i in range(40)]
    items = [(1, "Same same WORDS"), (None, "words")]
    table = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, terms int, shard string")
    got = lexical_search.lexical_search(table, spark.createDataFrame([(*q, 2) for q in items], "item_id long, text string, query int"), lexical_search.SearchParams(shard=2, visits=(1, 1)))
    assert rows_of(got) == searched(docs, items)
    assert [r["doc_id"] for r in got.where("item_id is null").orderBy("rank").collect()] == [3, 7, 7, None, None]


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for x, y in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0)), (docs.selectExpr("doc_id", "CAST(NULL AS STRING) AS text"), items)):
        assert lexical_search.lexical_search(x, y).count() == 0


def test_bisection_brings_topics_together():
    rng = np.random.default_rng(2)
    topic = rng.integers(0, 4, 400)
    lists = [np.unique(rng.integers(0, 40, 15) + 40 * t) for t in topic]
    at = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    tree = lexical_search.fit_bisection(np.concatenate(lists), at, lexical_search.SearchParams(depth=2))
    leaf = tree.leaves(np.concatenate(lists), at)
    pure = sum(max(Counter(topic[leaf == k].tolist()).values()) for k in set(leaf.tolist()))
    assert pure >= 0.95 * len(topic) and len(set(leaf.tolist())) == 4


# ---------------------------------------------------------------- importance resampling


def resampled(docs, target, percent=25, least=20):
    def features(text):
        ws = words(text)
        return len(ws), [zlib.crc32(x.encode()) % 10000 for x in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]]

    mine, s, t = [(i, *features(x)) for i, x in docs], Counter(), Counter()
    for _, _, f in mine:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    s_all, t_all, rows = s.total(), t.total(), []
    for i, n, f in mine:
        total = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in f)
        weight = total // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(*r[:4], k) for k, r in enumerate(able[: percent * len(able) // 100], 1)]
    return sorted(drawn + [(*r[:4], None) for r in able[len(drawn) :]] + [(*r[:4], None) for r in rows if r[4] < least], key=repr)


@pytest.mark.parametrize("nodes", [400_000, 50])
def test_resampling_against_brute_force(spark, nodes):
    texts, _ = corpus(3, 200)
    rng = random.Random(1)
    texts += [None, "", "?!", "A a A a", "word " * 19, "word " * 20, "long " + "q" * 70 + " " + "Q" * 70 + " end", "é" * 60 + " É ß " * 9, " ".join(rng.choices("abc", k=30_000))]
    docs = list(enumerate(texts))
    target = [" ".join(rng.choices(["w1", "w2", "w3", "A", "日本"], k=30)) for _ in range(5)] + [None]
    got = importance.resampled(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"), importance.ImportanceParams(nodes=nodes))
    assert rows_of(got) == resampled(docs, target)


def test_resampling_odd_tables(spark):
    text = " ".join(f"word{i}" for i in range(25))
    docs = [(None, text)] * 40 + [(8, text)] * 3 + [(8, None)]
    target = spark.createDataFrame([("word1 word2", 1)], "text string, n int")
    table = spark.createDataFrame([(*d, 5, "z") for d in docs], "doc_id long, text string, pos int, score string")
    assert rows_of(importance.resampled(table, target)) == resampled(docs, ["word1 word2"])
    assert importance.resampled(table.limit(0), target).count() == 0
    assert importance.resampled(table, target.limit(0)).where("rank is not null").count() == 10
    assert importance.resampled(table.where("text is null"), target).first()[1:] == (0, 0, importance.resampled(table.where("text is null"), target).first()["score"], None)


def test_crc_states_go_on():
    rng = random.Random(9)
    parts = [(bytes(rng.randrange(256) for _ in range(rng.randrange(0, 30))), bytes(rng.randrange(256) for _ in range(rng.randrange(0, 40)))) for _ in range(300)]
    states, alone = (np.array([zlib.crc32(p[k]) for p in parts], np.uint32) for k in (0, 1))
    got = importance.extended(states, alone, np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]
    assert len(importance.extended(states[:0], alone[:0], np.zeros(0, np.int64))) == 0


def test_query_draws_a_quarter(spark):
    got = QUERIES["op13_importance_resampling"](spark, FOLDER).toPandas()
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    target = pd.read_parquet(f"{FOLDER}/benchmark.parquet")
    want = resampled(list(zip(docs["doc_id"].tolist(), docs["text"], strict=True)), target["text"].tolist())
    assert sorted((tuple(None if x != x else int(x) for x in r) for r in got.itertuples(index=False)), key=repr) == want
