"""Character classes of the text operators, as regular-expression classes for the JVM and for Python alike.

The classes follow the lexicon's own conventions, not Unicode scripts: kanji takes in Greek letters with tonos to omega,
both kana classes hold the long mark and the wave dash, katakana the middle dot as well, and space excludes line feeds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column

KANJI = "一-鿿΄-ώ"
HIRAGANA = "぀-ゟー～"
KATAKANA = "゠-ヿー～・"
ALPHA = "A-Za-z"
ALNUM = "A-Za-z0-9"
SPACE = " 　\t"
ASCII = "\x20-\x7e"
TRIM = " 　\t\r\n"
ELISION = "\\-－ー～"

#: Named whole-string tests: the characters that may occur.
ONLY = {
    "kanji": KANJI,
    "katakana": KATAKANA + SPACE + "_",
    "kana": HIRAGANA + KATAKANA + SPACE + "_",
    "alpha": ALPHA + SPACE + "_.",
    "alpha_small": "a-z" + SPACE + "_.",
    "alnum": ALNUM + SPACE + "_.",
    "kana_name": HIRAGANA + KATAKANA + SPACE + "_・＝=",
    "kana_kanji": HIRAGANA + KATAKANA + KANJI + SPACE + "_.・＝",
    "kanji_space": KANJI + SPACE,
    "ascii": ASCII,
}
_ONLY = {name: re.compile(f"[{chars}]*") for name, chars in ONLY.items()}
_ONE = {name: re.compile(f"[{chars}]") for name, chars in {"kanji": KANJI, "hiragana": HIRAGANA, "katakana": KATAKANA, "alpha": ALPHA, "alnum": ALNUM, "space": SPACE, "elision": ELISION}.items()}
_READABLE = re.compile(f"[{HIRAGANA}{KATAKANA}{KANJI}{SPACE}{ASCII}]")


def only(text: str, name: str) -> bool:
    """Whether all characters belong to the named class; an empty text passes."""
    return _ONLY[name].fullmatch(text) is not None


def has(text: str, name: str) -> bool:
    return _ONE[name].search(text) is not None


def unreadable(text: str) -> bool:
    """Whether a text holds nothing that a Japanese font would show (``?`` alone counts as that)."""
    return text == "?" or (text != "" and _READABLE.search(text) is None)


def only_column(column: Column, name: str) -> Column:
    return column.rlike(f"^[{ONLY[name]}]*\\z")


def unreadable_column(column: Column) -> Column:
    return (column == "?") | ((column != "") & ~column.rlike(f"[{HIRAGANA}{KATAKANA}{KANJI}{SPACE}{ASCII}]"))
