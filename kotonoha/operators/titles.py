"""Predicates over titles and bodies, all native columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.charclass import only_column

# Titles that are no lexicon entries.
NOISE_EXACT = ("", "愛称", "名称", "通称", "呼称", "なし")
NOISE_PREFIX = (
    "Wikipedia:", "Category:", "File:", "Image:", "Help:", "User:", "Note:", "Template:", "Portal:", "カテゴリ:", "ファイル:", "画像:", "ノート:",
    "利用者:", "プロジェクト:", "年代", "世紀", "登場人物", "利用者", "スタブ", "国道", "日本の",
    "あ行", "か行", "さ行", "た行", "な行", "は行", "ま行", "や行", "ら行", "わ行",
)
NOISE_INSIDE = ("‐ノート", "○○", "用語", "/history", "最近の出来事", "…", "(旧暦)")
NOISE_SUFFIX = ("系電車", "形電車", "形貨車", "の作品", "年代")
# Of each pair both must occur.
NOISE_ERAS = ("紀元前", "明治", "大正", "昭和", "平成")
NOISE_ROADS = ("県道", "北海道道", "府道", "都道")
LUNAR_MONTHS = ("一月", "二月", "三月", "四月", "五月", "六月", "七月", "八月", "九月", "十月", "十一月", "十二月")
#: Whole titles that are a date or the beginning of one: ``1月``, ``11月1``, ``1日``, ``1年11月``; a full date may go on.
DATE = r"^[0-9](?:[0-9]?月?[0-9]{0,2}日?(?:年(?:[0-9]{0,2}|[0-9]{2}月[0-9]{0,2}|[0-9]{2}月[0-9]{2}日.*))?)\z"
REDIRECT = r"(?s)>#(?:転送|REDIRECT|redirect|Redirect).*\[\["


def _either(words: Iterable[str]) -> str:
    return "(?:" + "|".join(map(re.escape, words)) + ")"


def _noise_pattern() -> str:
    """All tests of a title in one expression, so that a title that is itself computed is computed once."""

    def both(a: str, b: str) -> list[str]:
        return [f"{a}.*{b}", f"{b}.*{a}"]

    starts = [rf"{_either(NOISE_EXACT)}\z", _either(NOISE_PREFIX), r"[0-9].*[年日]\z", DATE.removeprefix("^"), r"旧暦.*日\z", rf"{_either(LUNAR_MONTHS)}.*日\z"]
    inside = [_either(NOISE_INSIDE), rf"{_either(NOISE_SUFFIX)}\z", *both("年", _either(NOISE_ERAS)), *both("号", _either(NOISE_ROADS))]
    return f"(?s)^(?:{'|'.join(starts)})|{'|'.join(inside)}"


NOISE = _noise_pattern()


def is_list_page(title: Column) -> Column:
    return title.endswith("一覧")


def is_ascii(title: Column) -> Column:
    return only_column(title, "ascii")


def is_noise(title: Column) -> Column:
    """A namespace, date, era, road, row of the syllabary or other page that is no entry."""
    return title.rlike(NOISE)


def is_disambiguation(inner: Column) -> Column:
    return inner.rlike(r"\{\{(?:aimai|Aimai|AIMAI)\}\}")


def is_redirect(inner: Column) -> Column:
    """A redirect mark right behind the text tag, and a link somewhere after it."""
    return inner.rlike(REDIRECT)


def is_same_name(inner: Column) -> Column:
    return inner.contains("[[同姓同名]]")


def is_category_page(title: Column) -> Column:
    return title.contains("Category:")


def parsed_title(line: Column) -> Column:
    """Text of the first element whose name starts with t, up to the next tag; entities stay."""
    return F.regexp_extract(line, "<t[^>]*>([^<]*)", 1)
