"""The pipeline's stages, each held against a brute-force version on what it was given."""

import importlib
import os
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from kotonoha.llm import mixing, quality_model
from tests.llm.test_matching import brute
from tests.llm.test_placing import base, check_packing

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, FOLDER)
        got = spark.createDataFrame(got.collect(), got.schema)
        out.append((name, docs, got))
        docs = got
    return out


def test_stages_and_columns(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "pack"]
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(got.columns == columns for _, _, got in steps[:-1])


def test_quality(spark, steps):
    _, given, got = steps[0]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    want = {r["doc_id"] for r in quality_model.quality_scores(given, labels).where("predicted = 1").collect()}
    kept = {r["doc_id"] for r in got.collect()}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()} & {r["doc_id"] for r in given.collect()}
    assert kept == want and 0 < len(kept) < given.count() and len(good & kept) >= 0.97 * len(good)


def test_near_duplicates(steps):
    _, given, got = steps[1]
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    ids = sorted(texts)
    groups = brute([texts[i] for i in ids])
    assert {r["doc_id"] for r in got.collect()} == {ids[i] for i, (_, c) in groups.items() if i == c}


def test_personal_data(steps):
    _, given, got = steps[2]
    before, after = ({r["doc_id"]: r for r in df.collect()} for df in (given, got))
    assert set(before) == set(after)
    for i, r in after.items():
        assert not base(r["text"]) and r["n_chars"] == len(r["text"]) if base(before[i]["text"]) else True


def test_mix(steps):
    _, given, got = steps[3]
    ids = [r["doc_id"] for r in got.collect()]
    want = sorted(r["doc_id"] for r in mixing.mixed(given, mixing.MixParams(max_epochs=1)).collect())
    assert sorted(ids) == want and len(set(ids)) == len(ids) and len(ids) < given.count()


def test_pack(steps):
    _, given, got = steps[4]
    rows = given.collect()
    number = {r["doc_id"]: k for k, r in enumerate(rows)}
    renumbered = [r.asDict() | {"doc_id": number[r["doc_id"]]} for r in got.collect()]
    used, least = check_packing(renumbered, [r["text"] for r in rows])
    assert used <= 1.05 * least + 1


def test_run_equals_the_stages(spark, steps):
    assert {(r["doc_id"], r["piece"]) for r in corpus_pipeline.run(spark, FOLDER).collect()} == {(r["doc_id"], r["piece"]) for r in steps[-1][2].collect()}


def test_stages_take_nothing(spark):
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert all(stage(spark, empty, FOLDER).count() == 0 for _, stage in corpus_pipeline.STAGES)


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_the_rest_works_without_this_subpackage(tmp_path, with_pipeline):
    for name in ("kotonoha", "tests", "bench.py", "__spark_entry__.py", *["corpus_pipeline.py"] * with_pipeline):
        subprocess.run(["cp", "-r", str(REPO / name), str(tmp_path / name)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "kotonoha" / "llm"), str(tmp_path / "tests" / "llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    env = os.environ | {"PYTHONPATH": os.pathsep.join([str(tmp_path), *[p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != REPO]])}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
    # All that remains is collected, so nothing there needs the subpackage, and what needs no Spark runs.
    run = subprocess.run([sys.executable, "-m", "pytest", "-q", "--collect-only", "tests"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stdout[-2000:]
    run = subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", "tests/test_operators.py"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stdout[-2000:]


def test_entry_lists_all_thirteen():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
