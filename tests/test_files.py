"""File helpers, the command line and the streaming tables."""

import pytest

from kotonoha import streaming
from kotonoha.__main__ import main
from kotonoha.functions import files


def test_files(spark, tmp_path):
    a = str(tmp_path / "x" / "a.txt")
    files.write_text(spark, a, "1\n2\n3\n")
    assert files.exists(spark, a) and files.size(spark, a) == 6 and files.is_directory(spark, str(tmp_path / "x")) and not files.is_directory(spark, a)
    assert files.tail(spark, a, 2) == ["2", "3"] and files.whole_text(spark, a).first()["text"] == "1\n2\n3\n" and files.whole_bytes(spark, a).first()["size"] == 6
    assert files.copy(spark, a, str(tmp_path / "x" / "b.txt")) and files.move(spark, a, str(tmp_path / "x" / "c.txt")) and not files.exists(spark, a)
    files.set_modified(spark, str(tmp_path / "x" / "b.txt"), 1000)
    assert files.modified(spark, str(tmp_path / "x" / "b.txt")) == 1000
    names = [r["path"].rsplit("/", 1)[1] for r in files.listing(spark, str(tmp_path / "x"), "date", descending=True).collect() if r["path"].endswith(".txt")]
    assert names == ["c.txt", "b.txt"] and files.first_with_prefix(spark, str(tmp_path / "x"), "b").endswith("b.txt")
    assert files.rotate(spark, str(tmp_path / "x"), r"^[^.].*\.txt$", 1) == 1 and not files.exists(spark, str(tmp_path / "x" / "b.txt"))
    assert files.make_folders(spark, str(tmp_path / "y" / "z")) and files.delete(spark, str(tmp_path / "y"), tree=True)
    with pytest.raises(ValueError, match="root"):
        files.delete(spark, "/", tree=True)


PAGE = "<page>\n<title>{}</title>\n<text>{}</text>\n</page>\n"


def test_command_line(spark, tmp_path):
    (tmp_path / "p.xml").write_text(PAGE.format("山川", "'''山川'''（やまかわ）は\n[[Category:山]]") + PAGE.format("別名", "#REDIRECT [[山川]]"), encoding="utf-8")
    (tmp_path / "d.txt").write_text("BEE  B IY1\n", encoding="utf-8")
    for mode, source, want in (("yomi", "p.xml", "ヤマカワ\t山川"), ("category", "p.xml", "山川\t山"), ("ruigi", "p.xml", "山川\t別名"), ("cmudict", "d.txt", "ビー\t@BEE\tB IY1")):
        main([mode, str(tmp_path / source), str(tmp_path / mode)])
        assert [r["value"] for r in spark.read.text(str(tmp_path / mode)).collect()] == [want]
    with pytest.raises(SystemExit):
        main(["yomi", "a", "b", "--show=some"])


def test_streaming_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.xml").write_text(PAGE.format("バス", "'''バス'''（bus）\n[[Category:車]]"), encoding="utf-8")
    for name, column in (("english", "english"), ("categories", "title")):
        q = streaming.write(streaming.table(spark, name, str(tmp_path / "in")), str(tmp_path / name), str(tmp_path / f"{name}-cp"))
        q.processAllAvailable()
        q.stop()
        assert spark.read.parquet(str(tmp_path / name)).first()[column] in ("bus", "バス")
    sources = spark.createDataFrame([("バス", "乗合")], "target string, source string")
    joined = streaming.against_batch(streaming.stream_pages(spark, str(tmp_path / "in")), sources)
    q = joined.writeStream.format("memory").queryName("led").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("led").first()["source"] == "乗合"


def test_working_and_temporary_folders(spark, tmp_path):
    assert files.working_folder(spark)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("hadoop.tmp.dir")
    try:
        conf.set("hadoop.tmp.dir", str(tmp_path))
        path = files.temporary_folder(spark, "project")
        assert path == f"{tmp_path}/project" and files.is_directory(spark, path) and files.temporary_folder(spark, "project") == path
    finally:
        conf.set("hadoop.tmp.dir", before)
