"""Pages in, lexical tables out.

Title predicates are native and come first, so that pages without interest never reach Python. What needs nested or
positional scans runs in one Arrow UDF a table, on the title and the body; formatting and options are native again. The
one-pass tables take batch and streaming pages alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wikitext
from ..functions.kana import reading_case
from ..operators import characters as chara
from ..operators import english as eng
from ..operators import phonemes as pho
from ..operators import readings as yomi
from ..operators import synonyms as syn
from ..operators import titles as t
from ..operators.categories import categories_of


_CHARACTERS = "array<struct<reading:string,name:string,actor1:string,actor2:string,actor3:string>>"
#: Results of the text functions as Arrow has them.
_ARROW = {
    "string": pa.string(), "array<string>": pa.list_(pa.string()),
    _CHARACTERS: pa.list_(pa.struct([(name, pa.string()) for name in ("reading", "name", "actor1", "actor2", "actor3")])),
    "struct<reading:string,english:string>": pa.struct([("reading", pa.string()), ("english", pa.string())]),
}


@dataclass(frozen=True)
class Options:
    """``case`` kata, kana or none; ``show`` noempty, all or empty; ``disambiguation`` del or keep; ``raw_tags`` for hand-made pages.

    ``layouts`` names the layout of cast lists by patterns of titles, before the ones that are known and the one that fits best.
    """

    case: str = "kata"
    show: str = "noempty"
    disambiguation: str = "del"
    raw_tags: bool = False
    layouts: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        for name, allowed in (("case", ("kata", "kana", "none")), ("show", ("noempty", "all", "empty")), ("disambiguation", ("del", "keep"))):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {getattr(self, name)!r}")


def text_udf(function: Callable, kind: str) -> Callable:
    """A function of strings as an Arrow UDF over columns. Of a batch only a slice is held as Python strings at a time."""
    arrow = _ARROW[kind.replace(" ", "")]

    def run(batches: Iterator) -> Iterator[pa.Array]:
        for columns in batches:
            for rows in wikitext.slices(columns if isinstance(columns, tuple) else (columns,)):
                yield pa.array([function(*row) for row in rows], arrow)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)


def one_column_udf(function: Callable, kind: str) -> Callable:
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([function(x) for x in column], dtype=object)

    return F.pandas_udf(run, kind)


def strip_disambiguation(column: Column) -> Column:
    return one_column_udf(wikitext.strip_disambiguation, "string")(column)


def clean(column: Column) -> Column:
    return one_column_udf(wikitext.clean, "string")(column)


def _titles(options: Options) -> Column:
    """What the table prints as title: stripped of its parentheses or only cleaned. Plain titles stay in the JVM."""
    plain = ~F.col("title").rlike("[(（&'\\s{\\[]|\\z(?<=[ 　\t\r\n'])|^[ 　\t\r\n']")
    return F.when(plain, F.col("title")).otherwise(F.col("stripped") if options.disambiguation == "del" else clean(F.col("title")))


def _stripped(pages: DataFrame) -> DataFrame:
    plain = ~F.col("title").rlike("[(（&'\\s　{\\[]")
    return pages.withColumn("stripped", F.when(plain, F.col("title")).otherwise(strip_disambiguation(F.col("title"))))


def _shown(table: DataFrame, options: Options, full: Column, empty: Column | None = None) -> DataFrame:
    if options.show == "all":
        return table
    return table.where(full if options.show == "noempty" else (~full if empty is None else empty))


def categories(pages: DataFrame, options: Options = Options()) -> DataFrame:
    """(title, categories): category tags of articles, in order."""
    title, inner = F.col("title"), F.col("inner")
    body = pages.where(~t.is_noise(title) & ~t.is_list_page(title) & ~t.is_category_page(title))
    body = body.where(~t.is_redirect(inner) & ~t.is_disambiguation(inner) & ~t.is_same_name(inner))
    body = _stripped(body.select("title", categories_of(inner).alias("categories"))).where("stripped <> ''")
    return _shown(body.select(_titles(options).alias("title"), "categories"), options, F.size("categories") > 0)


def readings(pages: DataFrame, options: Options = Options()) -> DataFrame:
    """(reading, title): how titles are read. Titles in kana are their own reading and stay in the JVM."""
    title, inner = F.col("title"), F.col("inner")
    body = pages.where(~t.is_noise(title) & ~t.is_list_page(title) & ~t.is_ascii(title)).where(~t.is_redirect(inner))
    body = _stripped(body).where("stripped <> ''")
    found = text_udf(lambda a, b, whole, raw=options.raw_tags: yomi.reading(a, b, whole, raw_tags=raw), "string")
    kana = t.only_column(F.col("stripped"), "kana")
    own = F.translate("stripped", " -_・=＝", "")
    table = body.select(F.when(kana, own).otherwise(found("stripped", F.when(kana, "").otherwise(inner), title)).alias("reading"), _titles(options).alias("title"))
    table = _shown(table, options, F.col("reading") != "")
    return table.select(reading_case(F.col("reading"), options.case).alias("reading"), "title")


def english_words(pages: DataFrame, options: Options = Options()) -> DataFrame:
    """(reading, english): English words for titles in katakana, readings for titles in Latin letters."""
    title, inner = F.col("title"), F.col("inner")
    body = _stripped(pages.where(~t.is_noise(title) & ~t.is_list_page(title)).where(~t.is_redirect(inner))).where("stripped <> ''")
    body = body.where(t.only_column(F.col("stripped"), "katakana") | t.only_column(F.col("stripped"), "alpha"))
    found = text_udf(lambda a, b, raw=options.raw_tags: dict(zip(("reading", "english"), eng.english_pair(a, b, raw_tags=raw) or (None, None), strict=True)), "struct<reading:string,english:string>")
    table = body.select(found("stripped", "inner").alias("p")).select("p.reading", "p.english")
    table = _shown(table, options, (F.col("reading") != "") & (F.col("english") != ""), (F.col("reading") == "") & (F.col("english") == ""))
    return table.select(reading_case(F.col("reading"), options.case).alias("reading"), "english")


def redirect_sources(pages: DataFrame, options: Options = Options(), *, whole_rest: bool = True, full_targets: bool = False) -> DataFrame:
    """(target, source, ordinal): which pages lead to a title, by redirect or disambiguation.

    By default a target is a link's label without parentheses, and a ``#`` anywhere behind it drops the redirect. With
    ``whole_rest=False`` only the link itself is looked at; with ``full_targets`` redirects lead to the linked page's full
    title, found natively.
    """
    title, inner = F.col("title"), F.col("inner")
    body = pages.where(~t.is_noise(title) & ~t.is_list_page(title))
    body = body.where(t.is_redirect(inner) | t.is_disambiguation(inner)).select("ordinal", "title", "inner", t.is_redirect(inner).alias("redirect"))

    def targets(name: str, text: str, redirect: bool) -> list[str]:
        found = syn.redirect_target(name, text, whole_rest=whole_rest) if redirect else []
        return found or syn.disambiguation_targets(name, text, raw_tags=options.raw_tags)

    found = text_udf(targets, "array<string>")
    if not full_targets:
        return body.select(F.explode(found("title", "inner", "redirect")).alias("target"), F.col("title").alias("source"), "ordinal")
    link = F.regexp_extract("inner", r"(?s)>#(?:転送|REDIRECT|redirect|Redirect).*?\[\[([^|\]]*)", 1)
    direct = body.where("redirect").select(F.trim(link).alias("target"), F.col("title").alias("source"), "ordinal")
    others = body.where(~F.col("redirect")).select(F.explode(found("title", "inner", "redirect")).alias("target"), F.col("title").alias("source"), "ordinal")
    return direct.where((F.col("target") != "") & ~F.contains("target", F.lit("#")) & (F.col("target") != F.col("source"))).unionByName(others)


def synonyms(pages: DataFrame, options: Options = Options(), *, whole_rest: bool = True, full_targets: bool = False) -> DataFrame:
    """(title, synonyms): names stated by the article, then titles of pages that lead to it, in order of the export.

    ``pages`` needs ``ordinal``. Sources are grouped by target and joined to articles by title; the plan broadcasts the
    grouped side only when its size is known to be small, and merges sorted sides otherwise.
    """
    own = stated_synonyms(pages, options)
    sources = redirect_sources(pages, options, whole_rest=whole_rest, full_targets=full_targets).groupBy(F.col("target").alias("title")).agg(F.sort_array(F.collect_list(F.struct("ordinal", "source"))).alias("led"))
    joined = own.join(sources, "title", "left")
    led = F.coalesce(F.transform("led", lambda x: x["source"]), F.array().cast("array<string>"))
    return united_synonyms(joined.withColumn("led", led), options)


def stated_synonyms(pages: DataFrame, options: Options = Options()) -> DataFrame:
    """(title, own, stripped) of articles: the names that an article states itself."""
    title, inner = F.col("title"), F.col("inner")
    body = pages.where(~t.is_noise(title) & ~t.is_list_page(title))
    body = body.where(~t.is_redirect(inner) & ~t.is_disambiguation(inner) & ~t.is_same_name(inner))
    found = text_udf(lambda a, b, raw=options.raw_tags: syn.synonyms(a, b, raw_tags=raw), "array<string>")
    return _stripped(body.select("title", found("title", "inner").alias("own")))


def united_synonyms(joined: DataFrame, options: Options = Options()) -> DataFrame:
    """From (title, own, stripped, led and others): the title as it is printed, ``synonyms``, and the others."""
    others = [c for c in joined.columns if c not in ("title", "own", "stripped", "led")]
    names = F.filter(F.array_distinct(F.concat("own", "led")), lambda x: (x != F.col("title")) & (x != F.col("stripped")))
    if options.disambiguation == "del":
        # Names without a bracket, a quote or a blank are as they are; only lists that hold another go to Python.
        plain = ~F.exists(names, lambda x: x.rlike("[(（&'\\s　{\\[]"))
        strip = one_column_udf(lambda xs: [wikitext.strip_disambiguation(x) for x in xs] if xs is not None else None, "array<string>")
        names = F.when(plain, names).otherwise(strip(F.when(plain, None).otherwise(names)))
    table = joined.select(_titles(options).alias("title"), names.alias("synonyms"), *others)
    return _shown(table, options, F.size("synonyms") > 0)


def characters(pages: DataFrame, options: Options = Options()) -> DataFrame:
    """(reading, name, title, actor1, actor2, actor3): characters that an article lists, one row each."""
    title, inner = F.col("title"), F.col("inner")
    body = pages.where(~t.is_noise(title)).where(~t.is_redirect(inner) & ~t.is_disambiguation(inner) & ~t.is_same_name(inner))
    body = _stripped(body.where(chara.may_list_characters(title, inner))).where("stripped <> ''")
    found = text_udf(
        lambda a, b, raw=options.raw_tags, known=(*options.layouts, *chara.KNOWN_LAYOUTS): [c.as_row() for c in chara.find_characters(a, b, raw_tags=raw, known=known)],
        _CHARACTERS,
    )
    rows = body.select(_titles(options).alias("title"), F.explode(found("stripped", "inner")).alias("c"))
    table = _shown(rows.select("c.reading", "c.name", "title", "c.actor1", "c.actor2", "c.actor3"), options, F.col("reading") != "")
    return table.withColumn("reading", reading_case(F.col("reading"), options.case))


def phonetic_dictionary(entries: DataFrame, options: Options = Options(), rules: tuple[tuple[int, str, str], ...] = ()) -> DataFrame:
    """(kana, word, phonemes) of a pronouncing dictionary; ``case`` other than kata leaves hiragana."""
    kana = one_column_udf(lambda x: pho.to_kana(x, rules), "string")
    table = _shown(entries.select(kana("phonemes").alias("kana"), "word", "phonemes"), options, F.col("kana") != "")
    return table.withColumn("kana", reading_case(F.col("kana"), "kata")) if options.case == "kata" else table
