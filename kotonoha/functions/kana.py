"""Width and kana conversion. Tables are computed from the layout of the code blocks, with exceptions stated.

Options and their order of application: r/R letters and punctuation, n/N digits (a/A both), s/S space, k/K half-width and
katakana, c/C katakana and hiragana, h/H half-width and hiragana; a small letter of r, n, a, s narrows, a capital widens.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width punctuation and what it narrows to, first row first when widening.
PUNCTUATION = (
    "ｰー", "‘'", "’'", "“\"", "”\"", "（(", "）)", "〔[", "〕]", "［[", "］]", "｛{", "｝}", "〈<", "〉>", "《<", "》>", "「{", "」}", "『{", "』}",
    "【[", "】]", "・･", "！!", "♯#", "＆&", "＄$", "？?", "：:", "；;", "／/", "＼\\", "＠@", "｜|", "－-", "＝=", "≒=", "％%", "＋+", "÷/", "＊*", "～~",
)
# Half-width katakana in the order of their block, with the full-width letters they stand for.
HALF = "ｦｧｨｩｪｫｬｭｮｯｰｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜﾝ"
FULL = "ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン"


def _letters() -> list[tuple[str, str]]:
    return [(chr(ord(c) + 0xFEE0), c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"] + [(p[0], p[1:]) for p in PUNCTUATION]


def _hiragana(full: str) -> str:
    return "う゛" if full == "ヴ" else chr(ord(full) - 0x60) if "ァ" <= full <= "ン" else full


def _half_to_full() -> list[tuple[str, str]]:
    voiced = [(h + "ﾞ", "ヴ" if f == "ウ" else chr(ord(f) + 1)) for h, f in zip(HALF, FULL, strict=True) if f in "ウカキクケコサシスセソタチツテトハヒフヘホ"]
    popped = [(h + "ﾟ", chr(ord(f) + 2)) for h, f in zip(HALF, FULL, strict=True) if f in "ハヒフヘホ"]
    return voiced + popped + list(zip(HALF, FULL, strict=True))


def _katakana_to_hiragana() -> list[tuple[str, str]]:
    plain = [chr(c) for c in range(ord("ァ"), ord("ン") + 1) if chr(c) not in "ヰヱ"]
    return [("ヴ", "う゛")] + [(k, _hiragana(k)) for k in plain]


#: Option letter -> pairs (from, to), the first row that fits wins.
@lru_cache(maxsize=1)
def tables() -> dict[str, list[tuple[str, str]]]:
    digits = [(chr(0xFF10 + i), str(i)) for i in range(10)]
    half = _half_to_full()
    soft = [(h, _hiragana(f)) for h, f in half]
    base = {"r": _letters(), "n": digits, "s": [("　", " ")], "K": half, "c": _katakana_to_hiragana(), "H": soft}
    mirror = {"r": "R", "n": "N", "s": "S", "K": "k", "c": "C", "H": "h"}
    return base | {mirror[k]: [(b, a) for a, b in rows] for k, rows in base.items()}


def steps(options: str) -> list[str]:
    """The tables that an option string applies, in order."""
    out = []
    for low, high, both in (("r", "R", "aA"), ("n", "N", "aA"), ("s", "S", ""), ("k", "K", ""), ("c", "C", ""), ("h", "H", "")):
        if low in options or (both and both[0] in options):
            out.append(low)
        elif high in options or (both and both[1] in options):
            out.append(high)
    return out


@lru_cache(maxsize=32)
def _compiled(step: str) -> tuple[re.Pattern, dict[str, str]]:
    rows: dict[str, str] = {}
    for a, b in tables()[step]:
        rows.setdefault(a, b)
    # Only the voiced pairs are longer than one character, and they come first.
    return re.compile("|".join(map(re.escape, rows))), rows


def convert(text: str, options: str) -> str:
    for step in steps(options):
        pattern, rows = _compiled(step)
        text = pattern.sub(lambda m, rows=rows: rows[m[0]], text)
    return text


def convert_column(column: Column, options: str) -> Column:
    """The same within the JVM: longer pairs by ``replace``, all single characters by one ``translate``."""
    for step in steps(options):
        _, rows = _compiled(step)
        one = {a: b for a, b in rows.items() if len(a) == 1 and len(b) == 1}
        for a, b in rows.items():
            if len(a) > 1 or len(b) > 1:
                column = F.replace(column, F.lit(a), F.lit(b))
        column = F.translate(column, "".join(one), "".join(one.values()))
    return column


def reading_case(column: Column, case: str) -> Column:
    """``kata``, ``kana`` or ``none``."""
    return {"kata": lambda: convert_column(column, "KC"), "kana": lambda: convert_column(column, "Hc"), "none": lambda: column}[case]()
