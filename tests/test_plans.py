"""Plans end to end: a small export, every table and option, native forms against Python, streaming, SQL of the queries."""

import itertools
import random

import duckdb
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kotonoha import page_queries, plans, queries, text_queries
from kotonoha.functions import charclass, kana, strings as st
from kotonoha.operators import synonyms, titles
from kotonoha.sources import pages as source
from kotonoha.sources import sinks
from tests import golden

PAGES = [
    ("ねこ", "'''ねこ'''は動物。\n[[Category:動物]]\n[[Category:ねこ|*]]"),
    ("山川町 (県)", "'''山川町'''（やまかわちょう、{{lang-en-short|x}}）は町。略称は「山町」。\n[[Category:町]]"),
    ("バス", "'''バス'''（{{lang-en-short|bus}}）は乗り物。"),
    ("Foo", "'''Foo'''（フー）は製品。"),
    ("山の一覧", "'''一覧'''\n[[Category:山]]"),
    ("1月", "月。"),
    ("旧町", "#REDIRECT [[山川町 (県)|山川町 (県)]]"),
    ("乗合", "#転送 [[バス]]"),
    ("あいまい", "題\n* [[バス]]を参照。\n{{aimai}}"),
    ("同名", "[[同姓同名]]\n[[Category:人名]]"),
    ("劇", "文\n== 登場人物 ==\n; 山田 太郎（やまだ たろう）\n: 声 - [[川本 一]]\n; 花子（はなこ）\n: 演 - [[林 二]]\n== 外 ==\n"),
    ("空", ""),
    ("長い頁", "'''長い頁'''（ながいぺーじ）\n" + "x" * 70_000 + "\n[[Category:長]]"),
]


@pytest.fixture(scope="module")
def export(tmp_path_factory):
    folder = tmp_path_factory.mktemp("export")
    body = "".join(f"  <page>\n    <title>{t}</title>\n    <ns>0</ns>\n    <revision>\n      <text xml:space=\"preserve\">{x}</text>\n    </revision>\n  </page>\n" for t, x in PAGES)
    (folder / "pages.xml").write_text(f"<mediawiki>\n{body}  <page>\n    <title>無文</title>\n  </page>\n</mediawiki>\n", encoding="utf-8")
    return str(folder)


@pytest.fixture(scope="module")
def pages(spark, export):
    return source.read_pages(spark, export).cache()


def test_source(pages):
    rows = pages.orderBy("ordinal").collect()
    assert [r["title"] for r in rows] == [t for t, _ in PAGES] + ["無文"]
    assert rows[0]["inner"].startswith('<text xml:space="preserve">\'\'\'ねこ') and rows[-1]["inner"] == "" and "</text>" not in rows[0]["inner"]


@pytest.mark.parametrize("compression", ["none", "bzip2"])
def test_large_exports_are_split_at_pages(spark, tmp_path, compression):
    from pyspark.sql import functions as F

    letters = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.sha2(F.concat_ws("-", F.col("id").cast("string"), i.cast("string")), 256)), " ")
    made = spark.range(0, 400, 1, 1).select(F.concat(F.lit("頁"), F.col("id").cast("string")).alias("title"), F.concat(F.lit("<text>"), letters).alias("inner")).union(
        spark.createDataFrame([("空", ""), ("無", None)], "title string, inner string")).coalesce(1)
    source.write_pages(made, str(tmp_path / "export"), compression=compression)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        got = source.read_pages(spark, str(tmp_path / "export"))
        tasks = got.select(F.spark_partition_id()).distinct().count()
        rows = got.orderBy("ordinal").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [(r["title"], r["inner"] if (r["inner"] or "").startswith("<text") else '<text xml:space="preserve">' + (r["inner"] or "")) for r in made.collect()]
    assert [(r["title"], r["inner"]) for r in rows] == want and tasks > 3


def test_no_export_no_rows(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        source.read_pages(spark, str(tmp_path / "none")).count()


def test_categories(pages):
    got = {r["title"]: list(r["categories"]) for r in plans.categories(pages).collect()}
    assert got == {"ねこ": ["動物", "ねこ"], "山川町": ["町"], "長い頁": ["長"]}
    assert {r["title"] for r in plans.categories(pages, plans.Options(disambiguation="keep")).collect()} == {"ねこ", "山川町 (県)", "長い頁"}
    assert plans.categories(pages, plans.Options(show="empty")).where("size(categories) > 0").count() == 0


def test_readings(pages):
    got = {r["title"]: r["reading"] for r in plans.readings(pages, plans.Options(case="kana")).collect()}
    assert got["ねこ"] == "ねこ" and got["山川町"] == "やまかわちょう" and got["長い頁"] == "ながいぺーじ" and "Foo" not in got and "旧町" not in got
    assert {r["title"]: r["reading"] for r in plans.readings(pages).collect()}["山川町"] == "ヤマカワチョウ"


def test_english(pages):
    assert {tuple(r) for r in plans.english_words(pages).collect()} == {("バス", "bus"), ("フー", "Foo")}


def test_synonyms(pages):
    got = {r["title"]: list(r["synonyms"]) for r in plans.synonyms(pages).collect()}
    assert got["バス"] == ["乗合", "あいまい"] and got["山川町"] == ["山町"]
    full = {r["title"]: list(r["synonyms"]) for r in plans.synonyms(pages, full_targets=True, whole_rest=False).collect()}
    assert full["山川町"] == ["山町", "旧町"] and full["バス"] == ["乗合", "あいまい"]
    plan = plans.synonyms(pages)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_characters(pages):
    got = {(r["name"], r["reading"], r["actor1"]) for r in plans.characters(pages, plans.Options(case="none")).collect()}
    assert got == {("山田太郎", "やまだたろう", "川本 一"), ("花子", "はなこ", "林 二")}


def test_phonemes(spark, tmp_path):
    (tmp_path / "words.txt").write_text(";;; note\nCAT  K AE1 T\nCAT(1)  K AE2 T\nDON'T  D OW1\nBEE  B IY0\n", encoding="utf-8")
    entries = source.read_phonemes(spark, str(tmp_path / "words.txt"))
    assert {tuple(r) for r in plans.phonetic_dictionary(entries).collect()} == {("キャト", "CAT", "K AE1 T"), ("ビー", "BEE", "B IY0")}
    (tmp_path / "rules.tsv").write_text("1\tK AE T\tきゃっと\n", encoding="utf-8")
    rules = source.read_rules(spark, str(tmp_path / "rules.tsv"))
    assert "きゃっと" in {r["kana"] for r in plans.phonetic_dictionary(entries, plans.Options(case="kana"), rules).collect()}


@pytest.mark.parametrize("case, show, keep", list(itertools.product(("kata", "kana", "none"), ("noempty", "all", "empty"), ("del", "keep"))))
def test_options_split_the_rows(pages, case, show, keep):
    if case != "kata" and show != "all":
        return
    o = plans.Options(case, show, keep)
    few = pages.where("length(inner) < 1000")
    for table, column in ((plans.readings, "reading"), (plans.categories, "categories")):
        rows = table(few, o).collect()
        assert all((len(r[column]) > 0) == (show == "noempty") for r in rows) or show == "all"


def test_bad_options():
    with pytest.raises(ValueError, match="show"):
        plans.Options(show="some")


def test_sinks(spark, pages, tmp_path):
    sinks.write_tsv(plans.categories(pages).orderBy("title"), str(tmp_path / "out"))
    assert {r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()} == {"ねこ\t動物\tねこ", "山川町\t町", "長い頁\t長"}
    sinks.write_parquet(plans.categories(pages), str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 3


def test_streaming_equals_batch(spark, export, pages):
    stream = source.stream_pages(spark, export)
    query = plans.readings(stream).writeStream.format("memory").queryName("readings_stream").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert {tuple(r) for r in spark.table("readings_stream").collect()} == {tuple(r) for r in plans.readings(pages).collect()}


def test_native_equals_python(spark):
    words = ["", "1月", "11月1", "1年11月", "1年1月", "昭和5年", "国道1号", "県道2号", "日本の山", "系電車", "あ行", "正月", "一月三日", "旧暦1日", "ABC", "File:x", "2011年11月11日x", "12345", "猫 ", "カタ・カナ", "Ωω", "?", "ж", "かなカナ漢字Ａ１ｱｶﾞ"]
    rng = random.Random(5)
    words += ["".join(rng.choice("漢字山かなのカナヴーｱｶﾞﾊﾟＡ１a1Z _・-年月日123一覧の昭和旧暦県道号File:…‐～Ωж") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(words)], "i int, s string")
    rows = df.select(
        "i", titles.is_noise(F.col("s")).alias("noise"), charclass.unreadable_column(F.col("s")).alias("tofu"), *[charclass.only_column(F.col("s"), n).alias(n) for n in charclass.ONLY],
        *[kana.convert_column(F.col("s"), o).alias(f"k_{i}") for i, o in enumerate(("KC", "Hc", "a", "A", "sk", "hS"))],
    ).collect()
    for r in rows:
        x = words[r["i"]]
        assert r["noise"] == (x == "" or synonyms.noise(x)) and r["tofu"] == charclass.unreadable(x), x
        assert all(r[n] == charclass.only(x, n) for n in charclass.ONLY), x
        assert [r[f"k_{i}"] for i in range(6)] == [kana.convert(x, o) for o in ("KC", "Hc", "a", "A", "sk", "hS")], x


def test_page_predicates(spark):
    rows = [("<text>#REDIRECT [[a]]", True, False), ("<text>#転送[[a]]", True, False), ("<text>#ReDirect [[a]]", False, False), ("<text>#redirect a", False, False), ("<text>x{{Aimai}}", False, True), ("<text> #REDIRECT [[a]]", False, False)]
    got = spark.createDataFrame([(x,) for x, *_ in rows], "s string").select(titles.is_redirect(F.col("s")), titles.is_disambiguation(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(a, b) for _, a, b in rows]


def test_string_functions(spark):
    one = spark.range(1).select(F.lit("x").alias("x"))

    def value(column):
        return one.select(column.alias("v")).first()["v"]

    s = F.lit
    assert value(st.header_case(s("content-TYPE"))) == "Content-Type" and value(st.is_number(s("-1.5"))) and not value(st.is_number(s(""))) and value(st.leading_int(s(" 12ab"))) == 12
    assert value(st.find_last(s("abcab"), "ab")) == 3 and value(st.find_last(s("x"), "ab")) == -1 and value(st.find_any_case(s("aBc"), "bC")) == 1 and value(st.count_of(s("aaa"), "aa")) == 1
    assert value(st.split_two(s("a=b=c"), "=")).asDict() == {"left": "a", "right": "b=c"} and value(st.split_two(s("a"), "=")).asDict() == {"left": "", "right": ""}
    assert value(st.parse_pairs(s("a=1&b&a=2"), "&", "=")) == {"a": "1", "b": ""} and value(st.join_pairs(F.create_map(s("a"), s("1")), "&", "=")) == "a=1"
    assert value(st.between(s("a<b>c"), "<", ">")) == "b" and value(st.replace_between(s("a<b>c<d>"), "<", ">", "$1")) == "a<$1>c<$1>"
    assert value(st.bigrams(s("abc"))) == ["ab", "bc"] and value(st.bigrams(s("a"))) == ["a"] and value(st.bigrams(s(""))) == [] and value(st.shorten(s("abcdefgh"), 5)) == "ab..."
    assert value(st.html_escape(s("<a&'\">"))) == "&lt;a&&#039;&quot;&gt;" and value(st.json_text(s('a"/\n'))) == '"a\\"\\/\\n"' and value(st.shell_quote(s("a'b"))) == "'a'\\''b'"
    assert value(st.url_encode(s("a b/é~"))) == "a%20b%2f%c3%a9~" and value(st.url_decode(s("a%20b%zz+c"))) == "a b%zz c" and value(st.mime_header(s("é"))) == "=?utf-8?B?w6k=?="
    assert [value(f(s("/a/b.tar.GZ"))) for f in (st.extension, st.extension_plain, st.directory, st.file_name, st.file_stem)] == [".GZ", "gz", "/a", "b.tar.GZ", "b.tar"]
    assert value(st.host_url(s("http://a.b:80/c?d"))) == "http://a.b:80" and value(st.base_url(s("http://a.b/c/d?e"))) == "http://a.b/c/" and value(st.combine_path(s("a/"), s("b"))) == "a/b"
    assert value(st.glob(s("abc.txt"), "a*.t?t")) and not value(st.glob(s("abc"), "b*")) and value(st.common_prefix_length(s("abx"), s("aby"))) == 2 and value(st.unquote(s("'a'"))) == "a"
    assert value(st.mail_name(s("a@b.c"))) == "a" and value(st.mail_domain(s("a@b.c"))) == "b.c" and value(st.key_value(s("a=1&b=22"), "b")) == 22 and value(st.key_value(s("a=1"), "b")) is None
    assert str(value(st.parse_time(s("2012/8/3 2:2:8")))) == "2012-08-03 02:02:08" and value(st.parse_http_date(s("Sun, 06 Nov 1994 08:49:37 GMT"))) == 784111777
    assert value(st.human_size(F.lit(5000).cast("long"))) == "4KB" and value(st.template_if(s("a{x}b{/x}c"), "x", s(False))) == "ac" and value(st.template_if(s("a{x}b{/x}c"), "x", s(True))) == "abc"
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-12-31')) AS d").where(st.is_japanese_holiday(F.col("d"))).collect()
    assert [f"{r['d']:%m%d}" for r in days] == "0101 0108 0211 0212 0223 0320 0429 0503 0504 0505 0506 0715 0811 0812 0916 0922 0923 1014 1103 1104 1123".split()


QUERIES = queries.QUERIES | page_queries.QUERIES | text_queries.QUERIES
ORACLE_SQL = queries.ORACLE_SQL | page_queries.ORACLE_SQL | text_queries.ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("part", "documents", "pages", "events", "orders"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, folder).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)

    def rows(df: pd.DataFrame):
        return sorted(repr([list(x) if hasattr(x, "__len__") and not isinstance(x, str) else x.item() if hasattr(x, "item") else x for x in row]) for row in df[sorted(df.columns)].itertuples(index=False))

    assert rows(got) == rows(want)


@pytest.mark.parametrize("group", sorted(golden.PYTHON_GROUPS))
def test_golden_functions(group):
    for operator, function, arguments, want in golden.PYTHON_GROUPS[group]:
        assert golden.as_json(function(*arguments)) == golden.as_json(want), (operator, arguments)


@pytest.mark.parametrize("group", sorted(golden.NATIVE_GROUPS))
def test_golden_columns(spark, group):
    cases = golden.NATIVE_GROUPS[group]
    got = golden.native_results(spark, cases)
    assert [(c[0], c[2], r) for c, r in zip(cases, got, strict=True)] == [(c[0], c[2], golden.as_json({"v": c[3]})) for c in cases]


@pytest.mark.parametrize("name", sorted(golden.TABLES))
def test_golden_tables(spark, name):
    make, columns, want = golden.TABLES[name]
    got = make(spark).select(*columns.split(", ")).collect()
    assert sorted(repr([list(x) if isinstance(x, list) else x for x in r]) for r in got) == sorted(repr(list(r)) for r in want)


def test_a_parsed_title_is_extracted_once(spark, export):
    for table in (plans.categories, plans.readings, plans.english_words, plans.characters):
        plan = table(source.read_pages(spark, export))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract(value") == 2, plan


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLE_SQL))
def test_other_queries_give_rows(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_more_string_functions(spark):
    one = spark.range(1)

    def value(column):
        return one.select(column.alias("v")).first()["v"]

    s = F.lit
    assert value(st.arguments(s("a 'b c' \"d \\\" e\" f"))) == ["a", "b c", 'd " e', "f"] and value(st.keep_characters(s("a1b2"), lambda c: c.rlike("[0-9]"))) == "12"
    assert value(st.merge_maps(F.create_map(s("a"), s(1)), F.create_map(s("a"), s(2), s("b"), s(3)))) == {"a": 1, "b": 3} and value(st.maps_differ(F.create_map(s("a"), s(1)), F.create_map(s("a"), s(2))))
    assert value(st.md5(s("a"))) == "0cc175b9c0f1b6a831c399e269772661" and value(st.base64_decode(st.base64_encode(s("é")))) == "é" and len(value(st.random_text(7))) == 7
    assert value(st.unique(F.array(s(2), s(1), s(2)))) == [2, 1] and value(st.map_characters(s("ab"), lambda c: F.upper(c))) == "AB" and value(st.re_decode(F.unhex(s("E9")), "ISO-8859-1")) == "é"


def test_sql_names(spark, pages):
    from kotonoha.plans import sql

    assert "reading" in sql.register(spark)
    pages.createOrReplaceTempView("lexicon")
    row = spark.sql("SELECT reading(strip_disambiguation(title), inner) AS r, kana_convert('かな', 'C') AS k, snip('a(b)c', '(', ')') AS s, reading(NULL, inner) AS n FROM lexicon WHERE title LIKE '山川町%'").first()
    assert (row["r"], row["k"], row["s"], row["n"]) == ("やまかわちょう", "カナ", "ac", None)
    rows = spark.sql("SELECT c.name FROM lexicon, LATERAL character_rows(title, inner) AS c WHERE title = '劇'").collect()
    assert {r["name"] for r in rows} == {"山田太郎", "花子"}
    assert spark.sql("SELECT size(synonyms_of(title, inner)) AS n FROM lexicon WHERE title LIKE '山川町%'").first()["n"] == 1


def test_longest_piece_reads_whole_texts(spark, tmp_path):
    texts = ["a bb\nccc dddd\ne", "aa bb", "one\n\nlongest-of-all x", "", " ", None, "a " * 20_000 + "\n" + "last-and-longest"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["longest"] for r in queries.QUERIES["longest_piece"](spark, str(tmp_path)).collect()}
    assert got == {i: max(t.split(" "), key=len) if t is not None else None for i, t in enumerate(texts)}


def test_lexicon_pages_hold_whole_titles_and_texts(spark, tmp_path):
    titles_ = ["A title of more than twelve letters, é & 7!", "And more than a dozen letters", "a|b [c] #1", "Longer than a dozen letters at its very end"]
    html = [f'<html lang="en"><title>{t}</title><p>first of {i}</p>\n<p>{"word " * 4000}</p><b>last of {i}</b></html>' for i, t in enumerate(titles_)]
    spark.createDataFrame([(i + 3, f"http://a/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    made = {r["ordinal"]: r for r in queries.lexicon_pages(spark, str(tmp_path)).collect()}
    assert made[4]["title"] == titles_[1] and made[3]["title"] == titles_[0]
    assert [len(made[i + 3]["title"]) - more for i, more in ((2, 0), (3, 1))] == [len(titles_[2]), len(titles_[3])]
    for i, h in enumerate(html):
        assert h.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;") in made[i + 3]["inner"]
    got = {r["title"]: r["categories"] for r in queries.QUERIES["lexicon_categories"](spark, str(tmp_path)).collect()}
    assert got[titles_[1]] == ["en", titles_[1]] and ["en", titles_[3]] in got.values()
    assert {r["english"] for r in queries.QUERIES["lexicon_english"](spark, str(tmp_path)).collect()} >= {titles_[1]}
    assert titles_[3] in {r["actor1"] for r in queries.QUERIES["lexicon_characters"](spark, str(tmp_path)).collect()}


def test_made_readings_are_no_katakana_synonyms(spark, tmp_path):
    """Titles whose kana all lie beyond the first ten were given their reading in katakana, which counts as an abbreviation."""
    html = '<html lang="en"><title>No No</title><p>x</p></html>'
    spark.createDataFrame([(8, "u", html), (10, "u", html)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["title"]: r["synonyms"] for r in queries.QUERIES["lexicon_synonyms"](spark, str(tmp_path)).collect()}
    assert got == {"No No": ["せそ・せそ"], "セソ・セソ": ["せそ・せそ"]}


def test_text_functions_hold_slices_of_a_batch(spark):
    """However many rows a batch has, a function's results leave it slice by slice; rows and nulls stay in their places."""
    from kotonoha.functions import wikitext
    from kotonoha.plans.modes import text_udf

    batch = pa.array([str(i) if i % 3 else None for i in range(1000)])
    pieces = list(wikitext.slices((batch, batch)))
    assert max(map(len, pieces)) <= 128 and [a for piece in pieces for a, _ in piece] == batch.to_pylist()
    twice = text_udf(lambda a, b: None if a is None else [a, b], "array<string>")
    rows = spark.range(1000).coalesce(1).withColumn("s", F.when(F.col("id") % 3 > 0, F.col("id").cast("string"))).select("id", twice("s", "s").alias("v")).collect()
    assert [r["v"] for r in rows] == [[str(i)] * 2 if i % 3 else None for i in range(1000)]
