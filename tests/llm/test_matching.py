"""N-gram Jaccard join and embedding near-duplicates against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kotonoha.llm import embedding_graph, jaccard
from kotonoha.llm.components import components


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(texts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, inverse, links = {}, defaultdict(list), []
    for i, t in enumerate(texts):
        ws = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())
        shared = Counter(j for x in sets[i] for j in inverse[x])
        links += [(j, i) for j, k in shared.items() if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k)]
        for x in sets[i]:
            inverse[x].append(i)
    return {i: (len(sets[i]), c) for i, c in roots(sets, links).items()}


def family(rng, words, copies, changes):
    base = [rng.choice(words) for _ in range(80)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(80)] = rng.choice(words)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("few, block", [(12, 2000), (2, 2000), (3, 7)])
def test_jaccard_groups(spark, docs_of, few, block):
    rng = random.Random(few * block)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [None, "", "  ", "a", "A", "a b", "a  b ", "one two three four five", "One two\nthree four five"]
    texts += family(rng, words, 60, 4) + family(rng, words, 30, 6) + [passage + " " + " ".join(rng.choice(words) for _ in range(n)) for n in range(5, 60)]
    texts += [" ".join(rng.choice(words) for _ in range(50)) for _ in range(40)]
    texts += texts[10:20] + [texts[30].upper()]
    docs = docs_of(texts).selectExpr("*", "1 AS h", "2 AS id", "3 AS component_id")
    rows = jaccard.jaccard_groups(docs, jaccard.JaccardParams(few=few, block=block)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(texts)
    assert len(rows) == len(texts)


def test_jaccard_of_salted_keys_and_hubs(spark, docs_of):
    rng = random.Random(77)
    words = [f"w{i}" for i in range(400)]
    texts = family(rng, words, 700, 3) + family(rng, words, 300, 7) + [" ".join(rng.choice(words) for _ in range(50)) for _ in range(40)]
    docs = docs_of(texts)
    for params in (jaccard.JaccardParams(piece=16, hub=9), jaccard.JaccardParams(piece=4, few=3, block=50, hub=2)):
        rows = jaccard.jaccard_groups(docs, params).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(texts)


def test_one_of_each_keeps_every_text_of_a_repeated_id(spark, docs_of):
    docs = docs_of(["one two three four five six", "alone is this text here today", "one two three four five six"])
    more = docs.where("doc_id = 0").selectExpr("doc_id", "'another text under the same id' AS text", "lang", "source", "n_chars")
    docs = docs.union(more).union(more).selectExpr("*", "1 AS h", "2 AS id", "3 AS _again")
    kept = sorted((r["doc_id"], r["text"]) for r in jaccard.one_of_each(docs).collect())
    every = {"one two three four five six", "alone is this text here today", "another text under the same id"}
    assert {t for _, t in kept} == every and len([t for _, t in kept if t.startswith("another")]) == 1


def test_texts_of_a_repeated_id_all_link(spark, docs_of):
    rng = random.Random(21)
    words = [f"w{i}" for i in range(300)]
    families = [family(rng, words, 4, 3) for _ in range(6)]
    # (id, text): ids 1, 2 and 50 stand with texts of several families, one of them empty, one twice.
    rows = [(10 * f + k, t) for f, texts in enumerate(families) for k, t in enumerate(texts)]
    rows += [(1, families[3][0]), (1, families[3][0]), (2, families[4][1] + " more words"), (2, ""), (2, None), (50, "a lonely text of an id that is there twice"), (50, "another lonely text of it"), (None, families[2][0]), (None, "x")]
    rows += [(99, "one"), (99, "two words"), (99, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = sorted({(i, t) for i, t in rows if i is not None}, key=repr)
    groups = brute([t for _, t in texts])
    links = [(number, group) for number, (_, group) in groups.items()]
    number = {i: len(texts) + k for k, i in enumerate(sorted({i for i, _ in texts}))}
    links += [(k, number[i]) for k, (i, t) in enumerate(texts) if (t or "").split()]
    reached = roots(range(len(texts) + len(number)), links)
    least = {}
    for i, node in number.items():
        least[reached[node]] = min(i, least.get(reached[node], i))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_groups(docs).collect()}
    assert {i: c for i, c in got.items() if i is not None} == {i: least[reached[node]] for i, node in number.items()} and got[None] is None
    # One text of each group stays, and every text that is near no other.
    kept = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each(docs).collect()]
    worded = [k for k, (_, t) in enumerate(texts) if (t or "").split()]
    assert len([t for i, t in kept if i is not None and (t or "").split()]) == len({groups[k][1] for k in worded})
    assert (2, "") in kept and (2, None) in kept and (99, "") in kept and (None, "x") in kept


def test_a_key_that_one_task_meets_50000_times_is_split(spark):
    from pyspark.sql import functions as F

    p = jaccard.JaccardParams()
    words = " ".join(f"word{i}" for i in range(28))
    texts = spark.range(0, 50_000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit(words + " x"), F.col("id").cast("string"), F.lit(" end")).alias("text"))
    found = texts.mapInArrow(jaccard._digests(p), "kind int, id long, n long, vector binary").cache()
    table = jaccard._order_table(found.where("kind = 1"), found.agg(F.sum("n")).first()[0], p)
    keyed = texts.mapInArrow(jaccard._prefix_keys(p, spark.sparkContext.broadcast(table)), "id long, n int, keys array<struct<key:long,salt:int>>")
    pieces = keyed.select(F.explode("keys").alias("k")).groupBy("k.key", "k.salt").count().orderBy(F.desc("count")).collect()
    hot = [r for r in pieces if r["salt"]]
    assert sum(r["count"] for r in hot if r["key"] == hot[0]["key"]) == 50_000 and pieces[0]["count"] <= 2 * p.piece


def test_counts_beyond_a_byte_are_exact():
    counts = np.array([0, 1, 255, 256, 70_000, 5_000_000_000, 3], np.int64)
    assert jaccard._unpacked_counts(jaccard._packed_counts(counts)).tolist() == counts.tolist()


def test_long_texts_hash_as_short_ones(monkeypatch):
    import pyarrow as pa

    from kotonoha.llm import bytewords as bw
    from kotonoha.llm import quality_model, quality_rules, toxicity

    rng = random.Random(6)
    texts = [" ".join("x" * rng.randint(1, 9) + str(rng.randint(0, 99)) + rng.choice(["", "\n", "!"]) for _ in range(rng.randint(0, 60))) for _ in range(40)] + ["y" * 700, "z" * 300 + " a", "", None]
    model = toxicity.ToxicityModel(toxicity.ToxicityParams(bits=10), np.random.default_rng(1).normal(size=1 << 10).astype(np.float32))

    def all_of(limit):
        out = []
        for block in bw.blocks(pa.array(texts, pa.large_string()), limit):
            found, at = bw.shingles(block)
            out += [found[at[i] : at[i + 1]].tolist() for i in range(len(at) - 1)]
        own = [quality_rules.statistics(b) for b in bw.blocks(pa.array(texts, pa.large_string()), limit)]
        slots = [quality_model.features(b, 12) for b in bw.blocks(pa.array(texts, pa.large_string()), limit)]
        bags = [s[at[i] : at[i + 1]].tolist() for s, at in slots for i in range(len(at) - 1)]
        return out, np.concatenate([x for x, _ in own]).tolist(), np.concatenate([y for _, y in own]).tolist(), bags, model.score(pa.array(texts, pa.large_string()))

    whole = all_of(1 << 20)
    monkeypatch.setattr(bw, "PIECE", 64)
    parts = all_of(1)
    assert whole[:4] == parts[:4] and np.allclose(whole[4], parts[4], atol=1e-6)


def test_jaccard_on_documents_repeats_and_nothing(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    want = brute([texts[i] for i in sorted(texts)])
    rows = jaccard.jaccard_groups(documents.union(documents.limit(20))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want and len(rows) == len(want)
    assert jaccard.jaccard_groups(documents.limit(0)).count() == 0
    kept = jaccard.one_of_each(documents)
    assert kept.columns == documents.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}


def test_tree_bound_loses_no_pair():
    rng = np.random.default_rng(2)
    points = rng.poisson(3, (300, 16)).astype(np.int32)
    points[150:] = np.maximum(points[:150] + rng.integers(-1, 2, (150, 16)), 0)
    sizes = points.sum(1)
    tree = jaccard.CountTree(points, sizes, 8)
    for i in range(0, 300, 7):
        bound = np.minimum(points, points[i]).sum(1)
        want = set(np.flatnonzero(175 * bound >= 75 * (sizes + sizes[i])))
        assert want <= set(tree.search(points[i], int(sizes[i]), 75).tolist())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7, 7)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r["id"]: r["component"] for r in components(df).collect()}
    ids = {x for e in edges for x in e}
    assert got == roots(ids, edges)


def test_components_by_star_rounds(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(150)] + [(7000, 7000)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(9)
    got = {r["id"]: r["component"] for r in components(df, few=0).collect()}
    assert got == roots({x for e in edges for x in e}, edges)


def test_components_of_more_edges_than_one_task_takes(spark):
    # Pairs (2i, 2i + 1) and, in other tasks, (2i + 1, 2i + 2) within runs of six nodes: every node has two centres.
    n = 300_000
    df = spark.range(n).selectExpr("id AS a", "CASE WHEN id % 6 = 5 THEN id ELSE id + 1 END AS b").repartition(8, "a")
    out = components(df)
    assert out.where("component <> id - id % 6").isEmpty() and out.count() == n


def test_embedding_groups_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    odd = [(90_001, None), (90_002, []), (90_003, [0.0] * 64), (90_004, [float("nan")] * 64), (90_005, [None] * 64), (90_006, [1.0, 2.0]), (90_007, [float("inf")] * 64), (90_008, rows[0][1])]
    df = spark.createDataFrame(rows + odd + rows[:5], "vec_id long, embedding array<float>").selectExpr("*", "1 AS label", "2 AS id", "3 AS v")
    got = {r["vec_id"]: r for r in embedding_graph.embedding_groups(df).collect()}
    sound = rows + [odd[-1]]
    x = np.array([v for _, v in sound], np.float64)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    near = x @ x.T >= 0.9
    ids = [i for i, _ in sound]
    true = sum(int(near[k].sum()) - 1 for k in range(len(ids)))
    found = sum(got[i]["n_links"] for i in ids)
    assert found <= true and found >= 0.97 * true
    component = roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    assert np.mean([got[i]["component_id"] == component[i] for i in ids]) >= 0.97
    for i, _ in odd[:-1]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert len(got) == len(sound) + len(odd) - 1
    assert embedding_graph.embedding_groups(df.limit(0)).count() == 0


def test_embedding_audit_sees_small_groups_and_stops_a_poor_result(spark, monkeypatch):
    rng = np.random.default_rng(8)
    big = [(i, (np.eye(16)[0] + rng.normal(0, 0.01, 16)).tolist()) for i in range(60)]
    pairs = [(100 + 2 * k + j, (np.eye(16)[k + 1] + rng.normal(0, 0.01, 16)).tolist()) for k in range(14) for j in (0, 1)]
    vectors = spark.createDataFrame([(i, 1, v) for i, v in big + pairs], "id long, copies long, v array<double>")
    counts = spark.createDataFrame([(i, 59) for i, _ in big], "id long, n long")
    # All pairs are missing: 28 of 3,568 links, but 28 of 88 queries.
    assert abs(embedding_graph.audit(vectors, counts, embedding_graph.GraphParams()) - 60 / 88) < 1e-9
    table = spark.createDataFrame(big + pairs, "vec_id long, embedding array<double>")
    monkeypatch.setattr(embedding_graph, "audit", lambda *_: 0.89)
    with pytest.raises(RuntimeError, match="recall"):
        embedding_graph.embedding_groups(table, embedding_graph.GraphParams(tries=1))


def test_embedding_groups_of_every_length(spark):
    rng = np.random.default_rng(4)
    rows = []
    for d, n in ((8, 40), (5, 30), (3, 12), (2, 1)):
        base = rng.normal(size=(4, d))
        rows += [(len(rows) + k, (base[k % 4] + rng.normal(0, 0.05, d)).tolist()) for k in range(n)]
    rows += [(1000, rows[45][1]), (1001, rows[75][1])]
    true, links = dict.fromkeys((i for i, _ in rows), 0), []
    for a, x in rows:
        for b, y in rows:
            if a != b and len(x) == len(y) and np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y)) >= 0.9:
                true[a] += 1
                links.append((a, b))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = roots(true, links)
    for params in (embedding_graph.GraphParams(), embedding_graph.GraphParams(part=20), embedding_graph.GraphParams(part=20, tries=0)):
        got = {r["vec_id"]: r for r in embedding_graph.embedding_groups(df, params).collect()}
        assert {i: r["component_id"] for i, r in got.items()} == want and {i: r["n_links"] for i, r in got.items()} == true


def test_embedding_cells_levels_parts_and_the_exact_way(spark):
    rng = np.random.default_rng(12)
    heads = rng.normal(size=(60, 24))
    x = np.concatenate([heads[rng.integers(0, 60, 900)] + rng.normal(0, 0.12, (900, 24)), heads[0] + rng.normal(0, 0.03, (300, 24))]).astype(np.float32).astype(np.float64)
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    ids = list(range(len(x)))
    component = roots(ids, [(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    for params in (
        embedding_graph.GraphParams(leaf=40, part=60), embedding_graph.GraphParams(leaf=10, fan=4, part=50, levels=3), embedding_graph.GraphParams(leaf=40, part=60, tries=0),
        embedding_graph.GraphParams(leaf=20, overlap=1, beam=1, starts=1, degree=1, pool=2, slack=0.0, tries=1),
    ):
        got = {r["vec_id"]: r for r in embedding_graph.embedding_groups(df, params).collect()}
        links = np.array([got[i]["n_links"] for i in ids])
        assert (links <= near.sum(1)).all() and links.sum() >= 0.97 * near.sum()
        assert np.mean([got[i]["component_id"] == component[i] for i in ids]) >= 0.97
        if not params.tries:
            assert (links == near.sum(1)).all() and all(got[i]["component_id"] == component[i] for i in ids)
