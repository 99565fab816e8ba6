"""General string, path, URL, digest and time functions as native columns, named by what they do.

Where a behaviour differs from the obvious built-in, the docstring says so.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRIM = " \t\r\n"


# ---- case, classes, numbers
def ascii_upper(s: Column) -> Column:
    return F.translate(s, _LOWER, _UPPER)


def ascii_lower(s: Column) -> Column:
    return F.translate(s, _UPPER, _LOWER)


def header_case(s: Column) -> Column:
    """``content-type`` to ``Content-Type``: letters at the start and behind hyphens in capitals, others small."""
    return F.array_join(F.transform(F.split(ascii_lower(s), "-", -1), lambda p: F.concat(ascii_upper(F.substring(p, 1, 1)), F.substring(p, 2, 2**30))), "-")


def is_number(s: Column) -> Column:
    """Non-empty, of digits, hyphens and points only."""
    return s.rlike(r"^[0-9.-]+\z")


def is_hex(s: Column) -> Column:
    return s.rlike(r"^[0-9A-Fa-f]+\z")


def is_letters(s: Column) -> Column:
    return s.rlike(r"^[A-Za-z]+\z")


def is_alphanumeric(s: Column) -> Column:
    return s.rlike(r"^[A-Za-z0-9]+\z")


def is_ascii(s: Column) -> Column:
    return s.rlike(r"^[\x00-\x7f]*\z")


def is_mail_address(s: Column) -> Column:
    """Loosely: an at sign and a point somewhere behind it."""
    return s.rlike(r"(?s)@.*\.")


def is_safe_name(s: Column) -> Column:
    """A file name without separators, wildcards or control characters."""
    return s.rlike(r"^[^\\/:*?\"<>|\x00-\x1f]+\z")


def has_no_line_break(s: Column) -> Column:
    return ~s.rlike("[\r\n]")


def has_no_line_break_or_equals(s: Column) -> Column:
    return ~s.rlike("[\r\n=]")


def leading_int(s: Column) -> Column:
    """Leading whole number, 0 if there is none."""
    return F.coalesce(F.regexp_extract(s, r"^\s*([+-]?[0-9]{1,18})", 1).try_cast("long"), F.lit(0))


def leading_unsigned(s: Column) -> Column:
    return F.coalesce(F.regexp_extract(s, "^([0-9]{1,18})", 1).try_cast("long"), F.lit(0))


def digit_count(n: Column) -> Column:
    """Digits of a non-negative number, 10 at most."""
    return F.least(F.char_length(n.cast("string")), F.lit(10))


# ---- finding
def find(s: Column, part: str) -> Column:
    """Place of the first occurrence from 0, -1 for none."""
    return F.instr(s, part) - 1


def find_last(s: Column, part: str) -> Column:
    back = F.instr(F.reverse(s), part[::-1])
    return F.when(back == 0, -1).otherwise(F.char_length(s) - back - len(part) + 1)


def find_any_case(s: Column, part: str) -> Column:
    return F.instr(ascii_lower(s), part.translate(str.maketrans(_UPPER, _LOWER))) - 1


def find_any(s: Column, chars: str) -> Column:
    return F.regexp_instr(s, F.lit("[" + re.escape(chars) + "]")) - 1


def count_of(s: Column, part: str) -> Column:
    """Occurrences that do not overlap."""
    return ((F.char_length(s) - F.char_length(F.replace(s, F.lit(part), F.lit("")))) / len(part)).cast("int")


def common_prefix_length(a: Column, b: Column) -> Column:
    n = F.least(F.char_length(a), F.char_length(b))
    return F.size(F.filter(F.sequence(F.lit(0), n), lambda i: (i > 0) & (F.substring(a, 1, i) == F.substring(b, 1, i))))


def glob(s: Column, pattern: str) -> Column:
    """``*`` any run, ``?`` one character."""
    return s.rlike("^" + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in pattern) + r"\z")


# ---- cutting and joining
def trim(s: Column, chars: str = TRIM) -> Column:
    return F.btrim(s, F.lit(chars))


def split(s: Column, mark: str) -> Column:
    """Pieces between marks, empty ones too."""
    return F.split(s, re.escape(mark), -1)


def split_two(s: Column, mark: str) -> Column:
    """Struct (left, right) around the first mark; both empty without one."""
    has = F.contains(s, F.lit(mark))
    left = F.substring_index(s, mark, 1)
    right = F.substring(s, F.char_length(left) + len(mark) + 1, F.char_length(s))
    return F.struct(F.when(has, left).otherwise("").alias("left"), F.when(has, right).otherwise("").alias("right"))


def parse_pairs(s: Column, between: str, within: str, *, trim_keys: bool = False) -> Column:
    """Map of ``key=value`` pieces: the first of equal keys counts, a piece without mark has an empty value."""
    entries = F.transform(split(s, between), lambda p: F.struct(F.substring_index(p, within, 1).alias("k"), F.when(F.contains(p, F.lit(within)), F.substring(p, F.instr(p, within) + len(within), 2**30)).otherwise("").alias("v")))
    if trim_keys:
        entries = F.transform(entries, lambda e: F.struct(F.when(e["v"] != "", trim(e["k"])).otherwise(e["k"]).alias("k"), e["v"].alias("v")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["k"] == k), 1)))


def join_pairs(m: Column, between: str, within: str) -> Column:
    return F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit(within), e["value"])), between)


def between(s: Column, a: str, b: str) -> Column:
    """First text between two marks, empty if one is missing."""
    return F.regexp_extract(s, f"(?s){re.escape(a)}(.*?){re.escape(b)}", 1)


def replace_between(s: Column, a: str, b: str, new: str) -> Column:
    """What stands between the marks, in each such span, replaced; the marks stay."""
    return F.regexp_replace(s, f"(?s){re.escape(a)}.*?{re.escape(b)}", (a + new + b).replace("\\", "\\\\").replace("$", "\\$"))


def template_if(s: Column, name: str, keep: Column) -> Column:
    """``{name}…{/name}`` kept without its marks or dropped."""
    a, b = re.escape("{" + name + "}"), re.escape("{/" + name + "}")
    return F.when(keep, F.regexp_replace(s, f"{a}|{b}", "")).otherwise(F.regexp_replace(s, f"(?s){a}.*?{b}", ""))


def remove(s: Column, *parts: str) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p), F.lit("")), parts, s)


def replace_all(s: Column, rows: list[tuple[str, str]]) -> Column:
    """Literal replacements one after the other."""
    return reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), rows, s)


def bigrams(s: Column) -> Column:
    """Runs of two characters, in order; a single character stands for itself."""
    n = F.char_length(s)
    return F.when(n < 2, F.filter(F.array(s), lambda x: x != "")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(s, i, 2)))


def shorten(s: Column, width: int, mark: str = "...") -> Column:
    """At most ``width`` characters, with the mark in place of what is cut."""
    return F.when(F.char_length(s) <= width, s).otherwise(F.concat(F.substring(s, 1, max(0, width - len(mark))), F.lit(mark)))


# ---- escapes
def html_escape(s: Column) -> Column:
    """Brackets and both quotes; ampersands stay."""
    return replace_all(s, [(">", "&gt;"), ("<", "&lt;"), ('"', "&quot;"), ("'", "&#039;")])


def line_breaks_to_html(s: Column) -> Column:
    """CR LF only; a bare line feed stays."""
    return F.replace(s, F.lit("\r\n"), F.lit("<br>"))


def json_text(s: Column) -> Column:
    """A JSON string with quotes; slashes are escaped, line separators become ``\\n``."""
    rows = [("\\", "\\\\"), ('"', '\\"'), ("/", "\\/"), ("\b", "\\b"), ("\f", "\\f"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\u2028", "\\n"), ("\u2029", "\\n")]
    return F.concat(F.lit('"'), replace_all(s, rows), F.lit('"'))


def json_pair(k: Column, v: Column) -> Column:
    return F.concat(json_text(k), F.lit(": "), json_text(v))


def without_line_breaks(s: Column) -> Column:
    return F.translate(s, "\r\n", "")


def double_quotes(s: Column) -> Column:
    return F.replace(s, F.lit('"'), F.lit('\\"'))


def unquote(s: Column) -> Column:
    """Without one pair of quotes of a kind around the whole."""
    return F.regexp_replace(s, r"""(?s)^(["'])(.*)\1\z""", "$2")


def shell_quote(s: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("'\\''")), F.lit("'"))


def url_encode(s: Column) -> Column:
    """Percent-encoding of all but unreserved characters, hexadecimals in small letters."""
    pairs = F.regexp_extract_all(F.lower(F.hex(F.encode(s, "UTF-8"))), F.lit("(..)"), F.lit(1))
    plain = [f"{ord(c):02x}" for c in _UPPER + _LOWER + "0123456789-._~"]
    return F.array_join(F.transform(pairs, lambda p: F.when(p.isin(plain), F.decode(F.unhex(p), "UTF-8")).otherwise(F.concat(F.lit("%"), p))), "")


def url_decode(s: Column) -> Column:
    """``%xx`` and ``+`` decoded; a percent sign that starts no pair stays."""
    safe = F.regexp_replace(s, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), s)


def mime_header(s: Column) -> Column:
    return F.concat(F.lit("=?utf-8?B?"), base64_encode(s), F.lit("?="))


# ---- paths and URLs
def extension(s: Column) -> Column:
    return F.regexp_extract(s, r"(\.[^./\\]*)\z", 1)


def extension_plain(s: Column) -> Column:
    return F.lower(F.regexp_extract(s, r"\.([^./\\]*)\z", 1))


def directory(s: Column) -> Column:
    return F.regexp_extract(s, r"^(.*)[/\\]", 1)


def file_name(s: Column) -> Column:
    return F.regexp_extract(s, r"([^/\\]*)\z", 1)


def file_stem(s: Column) -> Column:
    return F.regexp_extract(s, r"([^/\\]*?)(?:\.[^./\\]*)?\z", 1)


def is_full_path(s: Column) -> Column:
    return s.rlike(r"^(?:/|\\\\|[A-Za-z]:[\\/])")


def with_separator(s: Column, separator: str = "/") -> Column:
    return F.translate(s, "\\/", separator * 2)


def combine_path(base: Column, part: Column) -> Column:
    return F.when(is_full_path(part), part).otherwise(F.concat(F.rtrim(base, F.lit("/\\")), F.lit("/"), part))


def host_url(s: Column) -> Column:
    """Scheme, host and port; empty without ``//``."""
    return F.regexp_extract(s, "^(.*?//[^/?#]*)", 1)


def base_url(s: Column) -> Column:
    """Up to the last slash of the path."""
    return F.regexp_extract(s, r"^(.*?//[^/?#]*(?:/(?:[^?#]*/)?)?)", 1)


def with_protocol(s: Column, protocol: str) -> Column:
    return F.regexp_replace(s, "^[A-Za-z][A-Za-z0-9+.-]*://", f"{protocol}://")


def with_parameter(s: Column, name: str, value: str) -> Column:
    return F.concat(s, F.when(F.contains(s, F.lit("?")), "&").otherwise("?"), F.lit(f"{name}={value}"))


def mail_name(s: Column) -> Column:
    return F.when(F.contains(s, F.lit("@")), F.substring_index(s, "@", 1)).otherwise("")


def mail_domain(s: Column) -> Column:
    return F.when(F.contains(s, F.lit("@")), F.substring_index(s, "@", -1)).otherwise("")


def key_value(s: Column, key: str, within: str = "=", between_: str = "&") -> Column:
    """Whole number of ``key=…`` in a list of pairs; null if it is not there."""
    return F.regexp_extract(s, f"(?:^|{re.escape(between_)}){re.escape(key + within)}([0-9]{{1,18}})", 1).try_cast("long")


# ---- time
def parse_time(s: Column) -> Column:
    """Timestamps such as ``2012/8/3 2:2:8``."""
    return F.try_to_timestamp(s, F.lit("y/M/d H:m:s"))


def format_time(t: Column, pattern: str = "y/M/d H:m:s") -> Column:
    return F.date_format(t, pattern)


def http_date(t: Column) -> Column:
    return F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def parse_http_date(s: Column) -> Column:
    """Seconds since 1970 of the three date forms of HTTP; years of two digits are those from 1970 to 2069."""
    bare = F.regexp_replace(s, "^[A-Za-z]+,? +", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "^([0-9]{2}-[A-Za-z]{3}-)([7-9][0-9] )", "$119$2"), "^([0-9]{2}-[A-Za-z]{3}-)([0-6][0-9] )", "$120$2")
    forms = [F.try_to_timestamp(bare, F.lit(f)) for f in ("dd MMM yyyy HH:mm:ss 'GMT'", "dd-MMM-yyyy HH:mm:ss 'GMT'", "MMM d HH:mm:ss yyyy")]
    return F.unix_timestamp(F.coalesce(*forms))


def weekday_japanese(t: Column) -> Column:
    return F.substring(F.lit("日月火水木金土"), F.dayofweek(t), 1)


def weekday_english(t: Column) -> Column:
    return F.date_format(t, "EEE")


def month_japanese(t: Column) -> Column:
    return F.concat(F.month(t).cast("string"), F.lit("月"))


def month_english(t: Column) -> Column:
    return F.date_format(t, "MMM")


def is_after(t: Column, hour: int, minute: int) -> Column:
    return F.hour(t) * 60 + F.minute(t) >= hour * 60 + minute


def is_within(t: Column, start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Between two times of day, over midnight if the end comes first."""
    now, a, b = F.hour(t) * 60 + F.minute(t), start[0] * 60 + start[1], end[0] * 60 + end[1]
    return (now >= a) & (now <= b) if a <= b else (now >= a) | (now <= b)


def is_japanese_holiday(d: Column) -> Column:
    """Public holidays of Japan by the rules in force since 2007 (with the emperor's birthday of each reign, the shifts to
    Mondays, equinoxes by formula to 2099, holidays in lieu after Sundays, and days between two holidays)."""

    def fixed(x: Column) -> Column:
        y, m, day, weekday = F.year(x), F.month(x), F.dayofmonth(x), F.dayofweek(x)
        monday = (weekday == 2) & (F.floor((day - 1) / 7) + 1 == F.when(m.isin(1, 10), 2).otherwise(3)) & m.isin(1, 7, 9, 10)
        spring = F.floor(20.8431 + 0.242194 * (y - 1980) - F.floor((y - 1980) / 4))
        autumn = F.floor(23.2488 + 0.242194 * (y - 1980) - F.floor((y - 1980) / 4))
        stated = F.date_format(x, "MMdd").isin("0101", "0211", "0429", "0503", "0504", "0505", "1103", "1123")
        emperor = (F.date_format(x, "MMdd") == F.when(y >= 2020, "0223").when(y <= 2018, "1223").otherwise("none"))
        return stated | emperor | monday | ((m == 3) & (day == spring)) | ((m == 9) & (day == autumn)) | ((y >= 2016) & (F.date_format(x, "MMdd") == "0811"))

    lieu = reduce(lambda a, b: a | b, [reduce(lambda p, q: p & q, [fixed(F.date_sub(d, k)) for k in range(1, n + 1)]) & (F.dayofweek(F.date_sub(d, n)) == 1) for n in (1, 2, 3)])
    bridged = fixed(F.date_sub(d, 1)) & fixed(F.date_add(d, 1)) & (F.dayofweek(d) != 1)
    return F.coalesce(fixed(d) | lieu | bridged, F.lit(False))


def human_size(n: Column) -> Column:
    """Bytes with the largest unit that leaves a whole number."""
    out = F.concat(n.cast("string"), F.lit("B"))
    for power, unit in ((1, "KB"), (2, "MB"), (3, "GB"), (4, "TB")):
        out = F.when(n >= 1024**power, F.concat(F.floor(n / 1024**power).cast("string"), F.lit(unit))).otherwise(out)
    return out


def clamp(n: Column, low: int, high: int) -> Column:
    return F.least(F.greatest(n, F.lit(low)), F.lit(high))


# ---- lists and maps
def unique(values: Column) -> Column:
    """First occurrences, in order."""
    return F.array_distinct(values)


def merge_lists(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def merge_maps(a: Column, b: Column) -> Column:
    """Entries of both; of equal keys the first map's."""
    return F.map_concat(a, F.map_filter(b, lambda k, v: ~F.array_contains(F.map_keys(a), k)))


def maps_differ(a: Column, b: Column) -> Column:
    def entries(m: Column) -> Column:
        return F.array_sort(F.map_entries(m))

    return entries(a) != entries(b)


def keep_characters(s: Column, test) -> Column:
    """The characters for which ``test`` (a function of a column) holds."""
    return F.array_join(F.filter(F.split(s, ""), test), "")


def map_characters(s: Column, change) -> Column:
    return F.array_join(F.transform(F.split(s, ""), change), "")


def is_one_of(s: Column, values: list[str]) -> Column:
    return s.isin(values)


# ---- digests and codes
def md5(s: Column) -> Column:
    return F.md5(F.encode(s, "UTF-8"))


def sha1(s: Column) -> Column:
    return F.sha1(F.encode(s, "UTF-8"))


def base64_encode(s: Column) -> Column:
    """In one line."""
    return F.regexp_replace(F.base64(F.encode(s, "UTF-8")), "[\r\n]", "")


def base64_decode(s: Column) -> Column:
    return F.decode(F.unbase64(s), "UTF-8")


def hex_bytes(s: Column) -> Column:
    return F.unhex(s)


def to_bytes(s: Column) -> Column:
    return F.encode(s, "UTF-8")


def re_decode(raw: Column, charset: str) -> Column:
    """Text of bytes in a character set."""
    return F.decode(raw, charset)


def random_text(length: int, alphabet: str = _UPPER + _LOWER + "0123456789", seed: int | None = None) -> Column:
    """A random string for each row."""
    letters = [F.substring(F.lit(alphabet), (F.floor(F.rand(None if seed is None else seed + i) * len(alphabet)) + 1).cast("int"), F.lit(1)) for i in range(length)]
    return F.concat(*letters)


def identifier() -> Column:
    return F.uuid()


# ---- commands
def arguments(s: Column) -> Column:
    """Arguments of a command line: words, or text in single or double quotes, where a backslash keeps a quote."""
    found = F.regexp_extract_all(s, F.lit(r"""("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*'|[^ \t]+)"""), F.lit(1))
    return F.transform(found, lambda x: F.when(x.rlike(r"""(?s)^(["']).*\1\z"""), F.regexp_replace(F.substring(x, F.lit(2), F.char_length(x) - 2), r"""\\(["'])""", "$1")).otherwise(x))


# ---- time zones
def to_utc(t: Column, zone: str) -> Column:
    return F.to_utc_timestamp(t, zone)


def from_utc(t: Column, zone: str) -> Column:
    return F.from_utc_timestamp(t, zone)
