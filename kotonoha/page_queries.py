"""Registered queries on wikitext pages made of the driver's ``pages``: cast lists in every layout, disambiguation, exports.

A made page holds the page's whole HTML as text of its lead. Names are the letters of the HTML title in katakana and the
number of the page in kana digits, so that they are unique and no name is the beginning of another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import plans
from .functions import wikitext as w
from .sources import pages as page_source
from .sources.folders import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_LETTERS, _KATA, _HIRA = "abcdefghijklmnopqrstuvwxyz", "アイウエオカキクケコサシスセソタチツテトナニヌネノハ", "あいうえおかきくけこさしすせそたちつてとなにぬねのは"
_DIGITS, _KATA_DIGITS, _HIRA_DIGITS = "0123456789", "ヒフヘホマミムメモヤ", "ひふへほまみむめもや"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, kata, hira, digits, text): the name in both kana, the page's number in katakana, and the escaped HTML."""
    letters = F.regexp_replace(F.lower(F.regexp_extract("html", "<title[^>]*>([^<]*)", 1)), "[^a-z]", "")
    name = F.concat(letters, F.col("page_id").cast("string"))
    text = F.replace(F.replace(F.replace("html", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", F.translate(name, _LETTERS + _DIGITS, _KATA + _KATA_DIGITS).alias("kata"), F.translate(name, _LETTERS + _DIGITS, _HIRA + _HIRA_DIGITS).alias("hira"),
        F.translate(F.col("page_id").cast("string"), _DIGITS, _KATA_DIGITS).alias("digits"), text.alias("text"),
    )


_NAMED = f"""
WITH n AS (
  SELECT page_id, regexp_replace(lower(regexp_extract(html, '<title[^>]*>([^<]*)', 1)), '[^a-z]', '', 'g') || page_id AS name FROM pages
), k AS (
  SELECT page_id, translate(name, '{_LETTERS}{_DIGITS}', '{_KATA}{_KATA_DIGITS}') AS kata, translate(name, '{_LETTERS}{_DIGITS}', '{_HIRA}{_HIRA_DIGITS}') AS hira,
    translate(page_id::VARCHAR, '{_DIGITS}', '{_KATA_DIGITS}') AS digits FROM n
)
"""


def _chosen(number: Column, ways: list[Column]) -> Column:
    """The way whose place is the number modulo their count."""
    return F.element_at(F.array(*ways), (number % len(ways) + 1).cast("int"))


def cast_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, title, inner): a page with a cast list in one of eleven layouts, or on a character alone."""
    kata, hira, page = F.col("kata"), F.col("hira"), F.col("page_id")
    actor = F.concat(F.lit("[[声優"), F.translate("digits", _KATA_DIGITS, _HIRA_DIGITS), F.lit("]]"))

    def cast(before: str, between: str, after: str) -> Column:
        return F.concat(F.lit("== 登場人物 ==\n" + before), kata, F.lit("（"), hira, F.lit("）" + between), actor, F.lit(after + "\n== 外部 ==\n"))

    later = F.concat(F.lit("== 登場人物 ==\n=== "), kata, F.lit(" ===\n（"), hira, F.lit("）\n\n説明の文。\n\n[[声優|声]]："), actor, F.lit("\n\n=== 端役 ===\n（はやく）\n説明だけ。\n== 外部 ==\n"))
    alone = F.concat(F.lit("は、[[漫画]]に登場する[[架空の人物]]。\n"), F.lit(""))
    body = _chosen(page, [
        cast("=== ", " ===\n: 声 - ", ""), cast("==== ", " ====\n* 演 - ", ""), cast("===== ", " =====\n: 声 - ", ""), cast("; ", "\n: 声 - ", ""), cast("* ", "、演 - ", ""), cast("; ", "\n声 - ", ""),
        cast("; ", "\n;: 声 - ", ""), cast("; ", "、声 - ", ""), cast("{| class=wikitable\n|-\n|", "||", "\n|}"), later, alone,
    ])
    kind = page % 11
    title = F.when(kind == 10, kata).otherwise(F.concat(kata, F.when(kind == 9, "の登場人物").otherwise("劇")))
    lead = F.concat(F.lit("<text>'''"), title, F.lit("'''（"), hira, F.lit("）"), F.when(kind == 10, body).otherwise(F.lit("は劇。\n")), F.col("text"), F.lit("\n"), F.when(kind == 10, "").otherwise(body))
    return _named(spark, sf_dir).select(page.alias("ordinal"), F.inline(F.array(F.struct(title.alias("title"), lead.alias("inner")))))


@query(_NAMED + """
SELECT kata AS reading, CASE WHEN page_id % 11 < 9 THEN hira ELSE kata END AS name, CASE page_id % 11 WHEN 10 THEN kata WHEN 9 THEN kata || 'の登場人物' ELSE kata || '劇' END AS title,
  CASE WHEN page_id % 11 = 10 THEN '' ELSE '声優' || translate(digits, 'ヒフヘホマミムメモヤ', 'ひふへほまみむめもや') END AS actor1, '' AS actor2, '' AS actor3
FROM k
""")
def cast_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters from every layout of cast lists; the one with later actor lines is known by its title."""
    return plans.characters(cast_pages(spark, sf_dir), plans.Options(layouts=(("の登場人物$", "later3"),)))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, title, inner): articles with abbreviations in infobox and lead, and for every five of them a list that leads there."""
    named = _named(spark, sf_dir)
    page, kata, hira = F.col("page_id"), F.col("kata"), F.col("hira")
    article = F.concat(
        F.lit("<text>{{会社\n|略称 = ワ"), hira, F.lit("、[[ヲ"), hira, F.lit("]]\n}}\n'''"), kata, F.lit("'''（"), hira, F.lit("）は会社。略称は「"), hira, F.lit("」。"), F.lit("\n"), F.col("text"), F.lit("\n"),
    )
    articles = named.select(page.alias("ordinal"), kata.alias("title"), article.alias("inner"))
    link = F.concat(F.lit("[["), kata, F.lit("]]"))
    line = _chosen(page, [
        F.concat(F.lit("* "), link, F.lit("を参照。")), F.concat(F.lit("* "), link, F.lit(" - 町の名。")), F.concat(F.lit("* 町の名 → "), link), F.concat(F.lit("* "), link),
        F.concat(F.lit("* 略語のこと。"), link), F.concat(F.lit("* 町のひとつ。詳細は"), link, F.lit("を見よ。")),
    ])
    lists = named.groupBy(F.floor(page / 5).alias("five")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(page, line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    name = F.concat(F.lit("ン"), F.translate(F.col("five").cast("string"), _DIGITS, _KATA_DIGITS), F.lit("ン"))
    lists = lists.select((F.col("five") + 10_000_000_000).alias("ordinal"), name.alias("title"), F.concat(F.lit("<text>'''"), name, F.lit("'''\n"), F.col("lines"), F.lit("\n{{aimai}}")).alias("inner"))
    return articles.unionByName(lists)


@query(_NAMED + """
SELECT kata AS title, ['ワ' || hira, 'ヲ' || hira, hira] || CASE WHEN page_id % 6 < 5 THEN ['ン' || translate((page_id // 5)::VARCHAR, '0123456789', 'ヒフヘホマミムメモヤ') || 'ン'] ELSE [] END AS synonyms FROM k
""")
def disambiguation_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synonyms from infobox and lead, then from the lists whose bullets lead to the article."""
    return plans.synonyms(linked_pages(spark, sf_dir))


#: Letters as phonemes and what these must sound like: vowels of all columns of the kana grid, irregular pairs, longer rules.
_SPELLED = {
    "a": ("S T AA1", "スタ"), "b": ("B EY1", "ベー"), "c": ("CH AY1", "チャイ"), "d": ("D EH1", "デ"), "e": ("L EH0 T ER1", "レタ"), "f": ("F OW1", "フォー"), "g": ("G OW1", "ゴー"), "h": ("HH AY1", "ハイ"),
    "i": ("K R IY1", "クリー"), "j": ("JH AY1", "ジャイ"), "k": ("K OW1", "コー"), "l": ("L OW1", "ロー"), "m": ("M EY1", "メー"), "n": ("N OW1", "ノー"), "o": ("G R OW1", "グロー"), "p": ("P EY1", "ペー"),
    "q": ("K Y UW1", "クユー"), "r": ("R AY1", "ライ"), "s": ("S OW1", "ソー"), "t": ("T EY1", "テー"), "u": ("B UH1", "ブッ"), "v": ("V OY1", "ボイ"), "w": ("W AY1", "ワイ"), "x": ("EH1 K S", "エクス"),
    "y": ("Y UW1", "ユー"), "z": ("Z OW1", "ゾー"),
}
_RULES = ((1, "S T AA", "すた"), (1, "L EH T ER", "れた"), (1, "K R IY", "くりー"), (1, "K R", "くろ"))


def _cases(place: int) -> str:
    return "CASE c " + " ".join(f"WHEN '{letter}' THEN '{way[place]}'" for letter, way in _SPELLED.items()) + " END"


@query(f"""
SELECT replace(p_name, ' ', '') AS word, list_aggregate(list_transform(regexp_extract_all(lower(p_name), '[a-z]'), lambda c: {_cases(0)}), 'string_agg', ' ') AS phonemes,
  list_aggregate(list_transform(regexp_extract_all(lower(p_name), '[a-z]'), lambda c: {_cases(1)}), 'string_agg', '') AS kana
FROM part WHERE regexp_matches(lower(p_name), '[a-z]')
""")
def phoneme_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names spelled letter by letter as phonemes of many vowels, with longer rules given as a parameter."""
    letters = F.regexp_extract_all(F.lower("p_name"), F.lit("([a-z])"), F.lit(1))
    sounds = F.create_map(*[F.lit(x) for letter, (way, _) in _SPELLED.items() for x in (letter, way)])
    entries = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.translate("p_name", " ", "").alias("word"), F.array_join(F.transform(letters, lambda c: sounds[c]), " ").alias("phonemes"))
    return plans.phonetic_dictionary(entries.where("phonemes <> ''"), rules=_RULES)


@query(r"""
SELECT regexp_extract(html, '<title[^>]*>([^<]*)', 1) AS title, length(t) AS n_chars, md5(t) AS digest
FROM (SELECT html, '<text xml:space="preserve">' || replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS t FROM pages)
""")
def export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written out as an export, and scanned again: files split at the ends of pages."""
    folder = work_folder(spark)
    made = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.regexp_extract("html", "<title[^>]*>([^<]*)", 1).alias("title"), "html")
    text = F.replace(F.replace(F.replace("html", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page_source.write_pages(made.select("title", text.alias("inner")), folder)
    return page_source.read_pages(spark, folder).select("title", F.char_length("inner").cast("long").alias("n_chars"), F.md5(F.encode("inner", "UTF-8")).alias("digest"))


@query(_NAMED + r"""
, t AS (
  SELECT k.*, '{{会社' || chr(10) || '|略称 = ワ' || hira || ' ' || chr(10) || '|代表 = [[' || kata || '|x]]' || chr(10) || '}}' AS box, '''''''' || kata || '''''''（' || hira || '）は&lt;ref name=a&gt;注' || digits || '&lt;/ref&gt;会社。' AS said,
    replace(replace(replace(p.html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS text FROM k JOIN pages p USING (page_id)
)
SELECT page_id, 'ワ' || hira AS boxed, md5('<text>' || box || chr(10) || '''''''' || kata || '''''''（' || hira || '）は会社。') AS head, md5('<text>' || box || chr(10) || '''''''' || kata || '''''''（' || hira || '）は会社。') AS without_notes,
  md5(chr(10) || '== 丙 ==' || chr(10) || text) AS section, md5('<text>' || box || chr(10) || said || chr(10) || '== 乙 ==' || chr(10) || 'い' || digits || chr(10) || '== 丙 ==' || chr(10) || text || chr(10) || '== 丁 ==' || chr(10)) AS cut,
  'あ' || digits AS first_section, length(box) - 2 AS box_end, length('<text>' || box || chr(10)) + 3 AS bold_start, length('<text>' || box || chr(10)) + 3 + length(kata) AS bold_end, kata AS stripped, kata || 'と' || hira || '|' || digits AS unlinked,
  kata || '、' || hira AS listed, replace(hira, 'ー', '') AS plain, '一' || digits || '三' AS tagless, '前' || hira || '後[[' || kata || ']]' AS snipped_once, length(kata) + 1 AS last_mark, kata || ' & ' || hira AS cleaned
FROM t
""")
def wikitext_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infobox, head, notes, sections, brackets, names and tags of a page made of each row, its whole HTML in one section."""
    kata, hira, digits = F.col("kata"), F.col("hira"), F.col("digits")
    box = F.concat(F.lit("{{会社\n|略称 = ワ"), hira, F.lit(" \n|代表 = [["), kata, F.lit("|x]]\n}}"))
    inner = F.concat(
        F.lit("<text>"), box, F.lit("\n'''"), kata, F.lit("'''（"), hira, F.lit("）は&lt;ref name=a&gt;注"), digits, F.lit("&lt;/ref&gt;会社。\n== 甲 ==\nあ"), digits, F.lit("\n== 乙 ==\nい"), digits, F.lit("\n== 丙 ==\n"), F.col("text"), F.lit("\n== 丁 ==\n")
    )
    made = _named(spark, sf_dir).select("page_id", "kata", "hira", "digits", F.inline(F.array(F.struct(inner.alias("inner"), box.alias("box")))))

    def kernels(name: str, sound: str, number: str, body: str, boxed: str) -> tuple:
        head = w.head_of(body)
        bold = w.any_bracket(body, len("<text>") + len(boxed))
        return (
            w.infobox(head, "略称"), head, w.drop_elements(body.partition("\n==")[0], "ref"), w.section(body, "丙"), w.cut_section(body, "甲"), w.section(body, "甲").split("\n")[-1], w.bracket(boxed, "{{", "}}")[2], bold[1], bold[2],
            w.strip_disambiguation(f"{name} ({number})"), w.without_links(f"{name}と[[{sound}|{number}]]"), w.without_et_cetera(f"{name}、{sound}など"), w.plain_reading(f"{sound} ・"), w.drop_tag_marks(f"一&lt;br /&gt;{number}&lt;br&gt;三", "br"),
            w.snip(f"前{{{{x}}}}{sound}後[[{name}]]", "{{", "}}", once=True), w.last_of(f"「{name}」{sound}", ("」", "「"), len(name) + 1, 0)[0], w.clean(f" {name} &amp; &lt;b&gt;{sound}&lt;/b&gt;&lt;!-- x --&gt; "),
        )

    kind = "boxed string, head string, without_notes string, section string, cut string, first_section string, box_end long, bold_start long, bold_end long, stripped string, unlinked string, listed string, plain string, tagless string, snipped_once string, last_mark long, cleaned string"

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        fields = [part.split() for part in kind.split(", ")]
        arrow = pa.struct([(name, pa.int64() if of == "long" else pa.string()) for name, of in fields])
        for columns in batches:
            for rows in w.slices(columns):
                yield pa.array([dict(zip(arrow.names, kernels(*row), strict=True)) for row in rows], arrow)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    rows = made.select("page_id", F.arrow_udf(run, kind)("kata", "hira", "digits", "inner", "box").alias("k")).select("page_id", "k.*")
    return rows.withColumns({c: F.md5(F.encode(c, "UTF-8")) for c in ("head", "without_notes", "section", "cut")})


_KANJI_DIGITS = "零一二三四五六七八九"


def _formed(spark: SparkSession, sf_dir: str, title: Column, forms: list[Column]) -> DataFrame:
    """(ordinal, title, inner) of pages whose lead has one of the forms, with the page's whole HTML behind it."""
    lead = F.concat(F.lit("<text>"), _chosen(F.col("page_id"), forms), F.lit("\n"), F.col("text"), F.lit("\n== 外部 ==\n"))
    return _named(spark, sf_dir).select(F.col("page_id").alias("ordinal"), F.inline(F.array(F.struct(title.alias("title"), lead.alias("inner")))))


def _around(*parts: str, **columns: Column) -> Column:
    """Texts and, by their names, columns, one after the other."""
    return F.concat(*[columns[p] if p in columns else F.lit(p) for p in parts])


@query(_NAMED + f"""
SELECT '山' || translate(page_id::VARCHAR, '{_DIGITS}', '{_KANJI_DIGITS}') || '川' AS title, 'ヤマ' || digits || 'カワ' || CASE WHEN page_id % 10 = 8 THEN 'イ' ELSE '' END AS reading FROM k
""")
def reading_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of titles in kanji, stated in ten ways: brackets, infobox, ruby, another bold name, dates, italics, links, two readings."""
    title = F.concat(F.lit("山"), F.translate(F.col("page_id").cast("string"), _DIGITS, _KANJI_DIGITS), F.lit("川"))
    c = {"T": title, "R": F.concat(F.lit("やま"), F.translate("digits", _KATA_DIGITS, _HIRA_DIGITS), F.lit("かわ"))}
    forms = [
        _around("'''", "T", "'''（", "R", "）は地名。", **c), _around("'''", "T", "'''（", "R", " {{lang|en|x}}、別）は地名。", **c), _around("{{大学\n|ふりがな = ", "R", "、別\n}}\n'''", "T", "'''は地名。", **c),
        _around("'''", "T", "'''（{{音声ルビ|", "R", "}}、x）は地名。", **c), _around("'''別線'''（", "R", "）は地名。", **c), _around("'''", "T", "'''（", "R", "、1990年 - ）は人名。", **c),
        _around("'''", "T", "''' （''", "R", "'', '''K''') は", **c), _around("'''[[", "T", "]]'''（", "R", "）は", **c), _around("'''", "T", "'''（", "R", "／", "R", "い）は", **c), _around("『'''", "T", "'''』（", "R", "）は", **c),
    ]
    return plans.readings(_formed(spark, sf_dir, title, forms))


@query(_NAMED + """
SELECT 'バス' || kata AS reading, 'bus ' || regexp_replace(name, '[0-9]', '', 'g') AS english FROM k JOIN n USING (page_id) WHERE page_id % 10 < 9 AND regexp_matches(name, '[a-z]')
""")
def english_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English words of titles in katakana, stated in nine ways; a tenth states none."""
    letters = F.translate(F.regexp_replace("kata", f"[{_KATA_DIGITS}]", ""), _KATA, _LETTERS)
    # A name without letters has no word that could be stated.
    word = F.when(letters != "", F.concat(F.lit("bus "), letters)).otherwise("")
    title = F.concat(F.lit("バス"), F.col("kata"))
    c = {"T": title, "W": word}
    forms = [
        _around("'''", "T", "'''（", "W", "）は", **c), _around("'''", "T", "'''（{{lang-en-short|", "W", "}}）は", **c), _around("'''", "T", "'''（英: ", "W", "）は", **c), _around("'''", "T", "'''('''", "W", "''')は", **c),
        _around("'''", "T", "'''（{{Lang-en-short|[[w:", "W", "|", "W", "]]}}）とは", **c), _around("'''", "T", "'''（", "W", "、'''別'''）", **c), _around("'''", "T", "'''（英語: ", "W", "）は", **c),
        _around("'''", "T", "'''（{{en|", "W", "}}）は", **c), _around("'''", "T", "'''（{{lang|en|", "W", "}}）は", **c), _around("'''", "T", "'''は乗り物。", **c),
    ]
    return plans.english_words(_formed(spark, sf_dir, title, forms))


@query(_NAMED + f"""
SELECT kata || '社' AS title, [CASE page_id % 5 WHEN 0 THEN hira WHEN 1 THEN hira WHEN 2 THEN '甲乙' || translate(page_id::VARCHAR, '{_DIGITS}', '{_KANJI_DIGITS}') WHEN 3 THEN 'ワ' || kata ELSE 'ヲ' || hira END] AS synonyms FROM k
""")
def synonym_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that a lead states before or behind a mark, after a colon, in a bracket, or a redirect brings."""
    title = F.concat(F.col("kata"), F.lit("社"))
    c = {"T": title, "H": F.col("hira"), "K": F.concat(F.lit("甲乙"), F.translate(F.col("page_id").cast("string"), _DIGITS, _KANJI_DIGITS)), "W": F.concat(F.lit("ワ"), F.col("kata"))}
    forms = [
        _around("'''", "T", "'''は、略称は「", "H", "」。", **c), _around("'''", "T", "'''は会社。「", "H", "」とも呼ばれる。", **c), _around("'''", "T", "'''は会社。通称：", "K", "。", **c),
        _around("'''", "T", "'''（", "W", "）は会社。", **c), _around("'''", "T", "'''は会社。", **c),
    ]
    pages = _formed(spark, sf_dir, title, forms)
    redirects = _named(spark, sf_dir).where("page_id % 5 = 4").select(
        (F.col("page_id") + 10_000_000_000).alias("ordinal"), F.concat(F.lit("ヲ"), F.col("hira")).alias("title"), F.concat(F.lit("<text>#REDIRECT [["), title, F.lit("]]")).alias("inner")
    )
    return plans.synonyms(pages.unionByName(redirects))
