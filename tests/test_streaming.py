"""Synonyms of a stream: redirects before and after their article, restarts, pages that come again."""

import pytest

from kotonoha import plans
from kotonoha.sources.pages import read_pages
from kotonoha.streaming import synonyms as stream

EARLY = [("旧町", "#REDIRECT [[山川町]]"), ("乗合", "#転送 [[バス]]"), ("空", "")]
ARTICLES = [("山川町", "'''山川町'''（やまかわちょう）は町。略称は「山町」。"), ("バス", "'''バス'''は乗り物。"), ("無関係", "'''無関係'''は語。")]
LATE = [("大型車", "#REDIRECT [[バス]]"), ("あいまい", "題\n* [[バス]]を参照。\n* [[山川町]]を参照。\n{{aimai}}"), ("乗合", "#転送 [[バス]]"), ("山川町", "'''山川町'''（やまかわちょう）は町。略称は「川町」。")]


def export(folder, name, pages):
    body = "".join(f"<page>\n<title>{t}</title>\n<revision><text>{x}</text></revision>\n</page>\n" for t, x in pages)
    (folder / name).write_text(f"<mediawiki>\n{body}</mediawiki>\n", encoding="utf-8")


def run(spark, folder, out):
    query = stream.synonyms(spark, str(folder)).writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(out) + "-state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None
    return {r["title"]: sorted(r["synonyms"]) for r in stream.latest(spark.read.parquet(str(out))).collect()}


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", tmp_path / "out"


def test_redirects_wait_for_articles_over_restarts(spark, folders):
    folder, out = folders
    export(folder, "a.xml", EARLY)
    assert run(spark, folder, out) == {}
    export(folder, "b.xml", ARTICLES)
    assert run(spark, folder, out) == {"山川町": ["山町", "旧町"], "バス": ["乗合"]}
    export(folder, "c.xml", LATE)
    got = run(spark, folder, out)
    assert got == {"山川町": sorted(["川町", "旧町", "あいまい"]), "バス": sorted(["乗合", "大型車", "あいまい"])}
    # The same pages at once, the article in its last form: the batch table.
    pages = dict(EARLY + ARTICLES + LATE)
    export(folder.parent, "all.xml", list(pages.items()))
    assert got == {r["title"]: sorted(r["synonyms"]) for r in plans.synonyms(read_pages(spark, str(folder.parent / "all.xml"))).collect()}
    versions = {(r["title"], r["version"]) for r in spark.read.parquet(str(out)).collect()}
    assert versions == {("山川町", 1), ("山川町", 2), ("バス", 1), ("バス", 2)}
