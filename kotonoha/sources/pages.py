"""Sources: pages of a MediaWiki export, phoneme word lists, and batch or streaming readers of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_END = "</page>"


def page_columns(chunk: Column) -> tuple[Column, Column]:
    """(title, inner) of the text of one page element; entities stay escaped, ``inner`` starts with its text tag."""
    title = F.regexp_extract(chunk, r"<title>([^<]*)</title>", 1)
    inner = F.regexp_extract(chunk, r"(?s)(<text[^>]*>.*?)(?:</text>|\z)", 1)
    return title, inner


def _pages(lines: DataFrame, *more: str) -> DataFrame:
    title, inner = page_columns(F.col("value"))
    # Filters on a page do not pass a generator, so no test on a title extracts it anew.
    page = F.inline(F.array(F.struct(title.alias("title"), inner.alias("inner"))))
    return lines.where(F.contains("value", F.lit("<page>"))).select(*more, page)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Rows (ordinal, title, inner) of an export, split at the ends of pages; ``ordinal`` follows the order in the file.

    A page without text has an empty body and is kept; nothing carries over from one page to the next. Text files split
    for parallel reads at the same mark, so a large export, plain or in bzip2 blocks, is read by many tasks.
    """
    lines = spark.read.option("lineSep", PAGE_END).text(path)
    return _pages(lines.withColumn("ordinal", F.monotonically_increasing_id()), "ordinal")


def page_elements(pages: DataFrame) -> DataFrame:
    """One column ``value``: each page of (title, inner) as the lines of its export; ``inner`` with or without its text tag."""
    opened = F.when(F.startswith("inner", F.lit("<text")), F.col("inner")).otherwise(F.concat(F.lit('<text xml:space="preserve">'), F.coalesce("inner", F.lit(""))))
    return pages.select(F.concat(F.lit("  <page>\n    <title>"), F.coalesce("title", F.lit("")), F.lit("</title>\n    <ns>0</ns>\n    <revision>\n      "), opened, F.lit("</text>\n    </revision>\n  </page>")).alias("value"))


def write_pages(pages: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """Writes pages as an export that ``read_pages`` reads back: files of page elements, entities as they are."""
    page_elements(pages).write.mode(mode).option("compression", compression).text(path)


def stream_pages(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    """Streaming rows (title, inner) of exports that arrive in a folder."""
    lines = spark.readStream.option("lineSep", PAGE_END).option("maxFilesPerTrigger", files_per_trigger).text(path)
    return _pages(lines)


def _entries(lines: DataFrame) -> DataFrame:
    # Headwords of letters only: comments, alternates such as WORD(1) and words with apostrophes are left out.
    word = F.regexp_extract("value", r"^([A-Za-z]+) ", 1)
    phonemes = F.btrim(F.regexp_extract("value", r"^[A-Za-z]+ [^A-Za-z]*([A-Za-z].*)$", 1), F.lit(" \t\r\n"))
    return lines.select(word.alias("word"), phonemes.alias("phonemes")).where("word <> '' and phonemes <> ''")


def read_phonemes(spark: SparkSession, path: str) -> DataFrame:
    """Rows (word, phonemes) of a pronouncing dictionary."""
    return _entries(spark.read.text(path))


def stream_phonemes(spark: SparkSession, path: str) -> DataFrame:
    return _entries(spark.readStream.text(path))


def read_rules(spark: SparkSession, path: str) -> tuple[tuple[int, str, str], ...]:
    """Phoneme rules (stage, pattern, kana) of a tab-separated file, in order; some hundreds of rows, held by the driver."""
    rows = spark.read.option("sep", "\t").schema("stage int, pattern string, kana string").csv(path).collect()
    return tuple((r["stage"], r["pattern"], r["kana"]) for r in rows)
