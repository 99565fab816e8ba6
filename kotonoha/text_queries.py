"""Registered queries of the general text functions over the driver's tables, each with the same in DuckDB's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import kana
from .functions import strings as st
from .functions.charclass import only_column, unreadable_column

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digest(c: Column) -> Column:
    return F.md5(F.encode(c, "UTF-8"))


_KINDS = """CASE p_partkey % 9 WHEN 0 THEN p_partkey::VARCHAR WHEN 1 THEN lower(hex(p_partkey)) WHEN 2 THEN replace(p_name, ' ', '') WHEN 3 THEN replace(p_name, ' ', '@') || '.com' WHEN 4 THEN '-' || p_size || '.5'
  WHEN 5 THEN ' -' || p_size || p_type WHEN 6 THEN p_name || '=' || p_size WHEN 7 THEN p_name || chr(10) || p_brand ELSE p_size || '/' || p_brand END"""


@query(f"""
SELECT p_partkey, regexp_matches(s, '^[0-9.-]+$') AS is_number, regexp_matches(s, '^[0-9A-Fa-f]+$') AS is_hex, regexp_matches(s, '^[A-Za-z]+$') AS is_letters, regexp_matches(s, '^[A-Za-z0-9]+$') AS is_alphanumeric,
  contains(s, '@') AND contains(substr(s, strpos(s, '@')), '.') AS is_mail, NOT regexp_matches(s, '[\\\\/:*?"<>|\\x00-\\x1f]') AS is_safe, NOT contains(s, chr(10)) AS one_line,
  NOT contains(s, chr(10)) AND NOT contains(s, '=') AS one_line_plain, coalesce(try_cast(regexp_extract(s, '^ *([+-]?[0-9]+)', 1) AS BIGINT), 0) AS leading_int, coalesce(try_cast(regexp_extract(s, '^[0-9]+') AS BIGINT), 0) AS leading_unsigned,
  s IN ('1', 'red', 'small') AS one_of
FROM (SELECT p_partkey, {_KINDS} AS s FROM part)
""")
def string_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size, name = F.col("p_partkey"), F.col("p_size").cast("string"), F.col("p_name")
    ways = [
        k.cast("string"), F.lower(F.hex(k)), F.replace(name, F.lit(" "), F.lit("")), F.concat(F.replace(name, F.lit(" "), F.lit("@")), F.lit(".com")), F.concat(F.lit("-"), size, F.lit(".5")),
        F.concat(F.lit(" -"), size, F.col("p_type")), F.concat(name, F.lit("="), size), F.concat(name, F.lit("\n"), F.col("p_brand")), F.concat(size, F.lit("/"), F.col("p_brand")),
    ]
    s = F.col("s")
    made = _table(spark, sf_dir, "part").select(k, F.element_at(F.array(*ways), (k % len(ways) + 1).cast("int")).alias("s"))
    return made.select(
        k, st.is_number(s).alias("is_number"), st.is_hex(s).alias("is_hex"), st.is_letters(s).alias("is_letters"), st.is_alphanumeric(s).alias("is_alphanumeric"), st.is_mail_address(s).alias("is_mail"),
        st.is_safe_name(s).alias("is_safe"), st.has_no_line_break(s).alias("one_line"), st.has_no_line_break_or_equals(s).alias("one_line_plain"), st.leading_int(s).alias("leading_int"),
        st.leading_unsigned(s).alias("leading_unsigned"), st.is_one_of(s, ["1", "red", "small"]).alias("one_of"),
    )


@query("""
SELECT doc_id, CASE WHEN contains(text, 'the') THEN length(text) - strpos(reverse(text), 'eht') - 2 ELSE -1 END AS last_the, strpos(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'th') - 1 AS any_case,
  CASE WHEN regexp_matches(text, '[,;.]') THEN length(regexp_extract(text, '^[^,;.]*')) ELSE -1 END AS first_stop, md5(trim(text, ' .' || chr(10))) AS trimmed, len(string_split(text, ', ')) AS n_pieces,
  CASE WHEN contains(text, ', ') THEN md5(substr(text, strpos(text, ', ') + 2)) ELSE md5('') END AS right_part, starts_with(source, 'src') AS globbed, length(text) - length(replace(text, 'e', '')) AS n_e
FROM documents
""")
def string_finding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return _table(spark, sf_dir, "documents").select(
        "doc_id", st.find_last(text, "the").cast("long").alias("last_the"), st.find_any_case(text, "TH").cast("long").alias("any_case"), st.find_any(text, ",;.").cast("long").alias("first_stop"),
        _digest(st.trim(text, " .\n")).alias("trimmed"), F.size(st.split(text, ", ")).cast("long").alias("n_pieces"), _digest(st.split_two(text, ", ")["right"]).alias("right_part"),
        st.glob(F.col("source"), "src*").alias("globbed"), st.count_of(text, "e").cast("long").alias("n_e"),
    )


@query(r"""
SELECT doc_id, md5(replace(t, chr(13) || chr(10), '<br>')) AS breaks,
  md5('"' || replace(replace(replace(replace(replace(replace(t, '\', '\\'), '"', '\"'), '/', '\/'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"') AS json,
  md5('"' || lang || '": "' || source || '"') AS pair, md5(translate(t, chr(13) || chr(10), '')) AS one_line, md5(replace(t, '"', '\"')) AS quotes, md5('''' || replace(t, '''', '''\''''') || '''') AS shell,
  md5('=?utf-8?B?' || to_base64(encode(t)) || '?=') AS mime, md5(t) AS unquoted, md5(upper_ascii) AS upper_, md5(lower_ascii) AS lower_, md5(t) AS decoded, md5(t) AS unhexed, octet_length(encode(t)) AS n_bytes
FROM (SELECT doc_id, lang, source, replace(text, chr(10), chr(13) || chr(10)) AS t, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS upper_ascii,
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)
""")
def string_escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, t = F.col("text"), F.replace("text", F.lit("\n"), F.lit("\r\n"))
    return _table(spark, sf_dir, "documents").select(
        "doc_id", _digest(st.line_breaks_to_html(t)).alias("breaks"), _digest(st.json_text(t)).alias("json"), _digest(st.json_pair(F.col("lang"), F.col("source"))).alias("pair"),
        _digest(st.without_line_breaks(t)).alias("one_line"), _digest(st.double_quotes(t)).alias("quotes"), _digest(st.shell_quote(t)).alias("shell"), _digest(st.mime_header(t)).alias("mime"),
        _digest(st.unquote(F.concat(F.lit('"'), t, F.lit('"')))).alias("unquoted"), _digest(st.ascii_upper(text)).alias("upper_"), _digest(st.ascii_lower(text)).alias("lower_"),
        _digest(st.base64_decode(st.base64_encode(t))).alias("decoded"), _digest(F.decode(st.hex_bytes(F.hex(F.encode(t, "UTF-8"))), "UTF-8")).alias("unhexed"), F.octet_length(st.to_bytes(t)).cast("long").alias("n_bytes"),
    )


@query(r"""
WITH u AS (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS plain, page_id || '.tar.GZ' AS file FROM pages)
SELECT page_id, CASE WHEN contains(regexp_extract(plain, '[^/]*$'), '.') THEN '.' || split_part(regexp_extract(plain, '[^/]*$'), '.', -1) ELSE '' END AS ext, 'gz' AS ext_plain, regexp_extract(plain, '^(.*)/', 1) AS dir,
  regexp_extract(plain, '[^/]*$') AS file, page_id || '.tar' AS stem, false AS is_full, replace(replace(url, '/', chr(92)), chr(92), '/') AS slashes, regexp_extract(plain, '^(.*)/', 1) || '/' || file AS combined,
  regexp_extract(url, '^(.*?//[^/?#]*(/([^?#]*/)?)?)', 1) AS base, coalesce(try_cast(regexp_extract(url, '[?&]page=([0-9]+)', 1) AS BIGINT), -1) AS page, page_id || ';page:' || page_id || ';ref:x' AS pairs, 'user' || page_id AS mail_name, 'mail.example.com' AS mail_domain,
  'User-Agent-' || page_id AS header, 'a' || page_id || 'c' AS kept, 'ac' AS dropped
FROM u
""")
def paths_and_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    page, url = F.col("page_id").cast("string"), F.col("url")
    plain, file = F.regexp_replace(url, "[?#].*$", ""), F.concat(page, F.lit(".tar.GZ"))
    pairs = st.parse_pairs(F.concat(page, F.lit("&page="), page, F.lit("&ref=x&page=9")), "&", "=")
    joined = st.join_pairs(F.map_filter(pairs, lambda k, v: v != ""), ";", ":")
    mail, template = F.concat(F.lit("user"), page, F.lit("@mail.example.com")), F.concat(F.lit("a{x}"), page, F.lit("{/x}c"))
    return _table(spark, sf_dir, "pages").select(
        "page_id", st.extension(st.file_name(plain)).alias("ext"), st.extension_plain(file).alias("ext_plain"), st.directory(plain).alias("dir"), st.file_name(plain).alias("file"), st.file_stem(file).alias("stem"),
        st.is_full_path(url).alias("is_full"), st.with_separator(st.with_separator(url, "\\")).alias("slashes"), st.combine_path(st.directory(plain), file).alias("combined"), st.base_url(url).alias("base"),
        F.coalesce(st.key_value(F.regexp_replace(F.regexp_replace(url, r"^[^?]*\??", ""), "#.*$", ""), "page"), F.lit(-1)).alias("page"), F.concat(page, F.lit(";"), joined).alias("pairs"), st.mail_name(mail).alias("mail_name"), st.mail_domain(mail).alias("mail_domain"),
        st.header_case(F.concat(F.lit("USER-agent-"), page)).alias("header"), st.template_if(template, "x", F.lit(True)).alias("kept"), st.template_if(template, "x", F.lit(False)).alias("dropped"),
    )


@query("""
SELECT o_orderkey, t AS parsed, year(t) || '/' || month(t) || '/' || day(t) || ' ' || hour(t) || ':' || minute(t) || ':' || second(t) AS formatted, epoch(t)::BIGINT AS http, epoch(t)::BIGINT AS http_old,
  strftime(t, '%a') AS weekday, strftime(t, '%b') AS month, (hour(t) * 60 + minute(t) >= 1320 OR hour(t) * 60 + minute(t) <= 120) AS at_night, (hour(t) * 60 + minute(t) BETWEEN 540 AND 1020) AS by_day,
  t - INTERVAL 9 HOUR AS utc, t + INTERVAL 9 HOUR AS tokyo
FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS t FROM orders)
""")
def time_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    made = _table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))).cast("timestamp").alias("t"))
    old = F.date_format(t, "EEEE, dd-MMM-yy HH:mm:ss 'GMT'")
    return made.select(
        "o_orderkey", st.parse_time(st.format_time(t)).cast("timestamp_ntz").alias("parsed"), st.format_time(t).alias("formatted"), st.parse_http_date(st.http_date(t)).alias("http"), st.parse_http_date(old).alias("http_old"),
        st.weekday_english(t).alias("weekday"), st.month_english(t).alias("month"), st.is_within(t, (22, 0), (2, 0)).alias("at_night"), st.is_within(t, (9, 0), (17, 0)).alias("by_day"),
        st.to_utc(t, "Asia/Tokyo").cast("timestamp_ntz").alias("utc"), st.from_utc(t, "Asia/Tokyo").cast("timestamp_ntz").alias("tokyo"),
    )


@query("""
WITH w AS (SELECT p_partkey, p_name, p_brand, p_size, string_split(p_name, ' ') AS ws FROM part)
SELECT p_partkey, CASE WHEN ws[1] = ws[2] THEN ws[1] ELSE ws[1] || ',' || ws[2] END AS uniq, ws[1] || ',' || ws[2] || ',' || p_brand AS merged, 'a:' || p_size || ';b:2' AS maps, p_size <> 1 AS differ, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits,
  upper(p_name) AS mapped, p_name || '|' || 'b c' || '|' || p_brand AS args, length(p_name) - length(ltrim(p_name, substr(p_name, 1, 1))) AS lead, replace(replace(p_name, 'e', 'i'), 'i', 'o') AS replaced
FROM w
""")
def lists_and_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, brand, size = F.col("p_name"), F.col("p_brand"), F.col("p_size").cast("string")
    ws, one = F.split(name, " "), F.substring(name, 1, 1)
    a, b = st.parse_pairs(F.concat(F.lit("a="), size), "&", "="), st.parse_pairs(F.lit("a=1&b=2"), "&", "=")
    args = st.arguments(F.concat(F.lit('"'), name, F.lit("\" 'b c' "), brand))
    return _table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(st.unique(ws), ",").alias("uniq"), F.array_join(st.merge_lists(ws, F.array(brand)), ",").alias("merged"), st.join_pairs(st.merge_maps(a, b), ";", ":").alias("maps"),
        st.maps_differ(a, st.parse_pairs(F.lit("a=1"), "&", "=")).alias("differ"), st.keep_characters(brand, lambda c: c.rlike("[0-9]")).alias("digits"), st.map_characters(name, F.upper).alias("mapped"),
        F.array_join(args, "|").alias("args"), st.common_prefix_length(name, F.repeat(one, F.char_length(name))).cast("long").alias("lead"), st.replace_all(name, [("e", "i"), ("i", "o")]).alias("replaced"),
    )


_WIDE_LETTERS = "ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ"
_WIDE_DIGITS = "０１２３４５６７８９"
_LATIN, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789"
_SMALL, _FULL_KANA, _HALF_KANA = "abcdefghijklmnopqrstuvwxyz", "アイウエオカキクケコサシスセソタチツテトナニヌネノハ", "ｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊ"


@query(f"""
WITH s AS (SELECT p_partkey, p_name || ' ' || p_brand || p_size AS t, translate(lower(p_name), '{_SMALL}', '{_FULL_KANA}') AS full_, translate(lower(p_name), '{_SMALL}', '{_HALF_KANA}') AS half FROM part)
SELECT p_partkey, translate(t, '{_DIGITS}', '{_WIDE_DIGITS}') AS wide_digits, t AS narrow_digits, translate(t, '{_LATIN}#', '{_WIDE_LETTERS}♯') AS wide_letters, t AS narrow_letters,
  translate(t, '{_LATIN}{_DIGITS}#', '{_WIDE_LETTERS}{_WIDE_DIGITS}♯') AS wide, replace(t, ' ', '　') AS wide_spaces, t AS narrow_spaces, half AS half_kana, full_ AS full_kana,
  translate(full_, '{_FULL_KANA}', 'あいうえおかきくけこさしすせそたちつてとなにぬねのは') AS hira_of_half, true AS kana_only, false AS unreadable
FROM s
""")
def kana_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width of digits, letters, spaces and kana, there and back."""
    name = F.lower("p_name")
    made = _table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"), F.col("p_size").cast("string")).alias("t"), F.translate(name, _SMALL, _FULL_KANA).alias("full_"), F.translate(name, _SMALL, _HALF_KANA).alias("half")
    )

    def turned(c: Column, *options: str) -> Column:
        for option in options:
            c = kana.convert_column(c, option)
        return c

    t, full_, half = F.col("t"), F.col("full_"), F.col("half")
    return made.select(
        "p_partkey", turned(t, "N").alias("wide_digits"), turned(t, "N", "n").alias("narrow_digits"), turned(t, "R").alias("wide_letters"), turned(t, "R", "r").alias("narrow_letters"),
        turned(t, "S").alias("wide_spaces"), turned(t, "S", "s").alias("narrow_spaces"), turned(full_, "k").alias("half_kana"), turned(half, "K").alias("full_kana"),
        turned(half, "H").alias("hira_of_half"), only_column(F.replace(full_, F.lit(" "), F.lit("")), "katakana").alias("kana_only"), unreadable_column(t).alias("unreadable"), turned(t, "N", "R").alias("wide"),
    )
