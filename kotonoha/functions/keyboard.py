"""Keyboard slips: Latin spelling and hiragana, and keys of the kana layout struck in the wrong mode.

The spelling table is computed from the syllabary; only irregular spellings are listed. ``convert`` takes r (spelling to
hiragana), R (back), k (hiragana to the keys that give it) and K (keys to hiragana), applied in the order r, R, K, k.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Rows of the syllabary by consonant, and glides.
ROWS = {
    "": "あいうえお", "k": "かきくけこ", "s": "さしすせそ", "t": "たちつてと", "n": "なにぬねの", "h": "はひふへほ", "m": "まみむめも", "y": "や ゆ よ", "r": "らりるれろ", "w": "わ   を",
    "g": "がぎぐげご", "z": "ざじずぜぞ", "d": "だぢづでど", "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ",
}
# Spellings outside the grid.
IRREGULAR = {
    "shi": "し", "chi": "ち", "tsu": "つ", "fu": "ふ", "ji": "じ", "sha": "しゃ", "shu": "しゅ", "sho": "しょ", "she": "しぇ", "cha": "ちゃ", "chu": "ちゅ", "cho": "ちょ", "che": "ちぇ",
    "ja": "じゃ", "ju": "じゅ", "jo": "じょ", "je": "じぇ", "fa": "ふぁ", "fi": "ふぃ", "fe": "ふぇ", "fo": "ふぉ", "va": "ゔぁ", "vi": "ゔぃ", "vu": "ゔ", "ve": "ゔぇ", "vo": "ゔぉ",
    "wi": "うぃ", "we": "うぇ", "nn": "ん", "n'": "ん",
}
# The kana layout, a key and its kana.
KEYS = dict(zip("1234567890-^qwertyuiop@asdfghjkl;:]zxcvbnm,./\\#$%&'()E", "ぬふあうえおやゆよわほへたていすかんなにらせ゛ちとしはきくまのりれけむつさそひこみもねるめろぁぅぇぉゃゅょぃ", strict=True))
_VOICED = str.maketrans("かきくけこさしすせそたちつてとはひふへほ", "がぎぐげござじずぜぞだぢづでどばびぶべぼ")
_POPPED = str.maketrans("はひふへほ", "ぱぴぷぺぽ")


@lru_cache(maxsize=1)
def spellings() -> dict[str, str]:
    out = {c + v: row[i] for c, row in ROWS.items() for i, v in enumerate("aiueo") if row[i] != " "}
    for c, row in ROWS.items():
        if c and c not in "yw":
            out |= {f"{c}y{v}": row[1] + small for v, small in zip("aiueo", "ゃぃゅぇょ", strict=True)}
    for small, v in zip("ぁぃぅぇぉ", "aiueo", strict=True):
        out |= {f"l{v}": small, f"x{v}": small}
    for small, v in zip("ゃゅょ", "auo", strict=True):
        out |= {f"ly{v}": small, f"xy{v}": small}
    out |= {"ltu": "っ", "xtu": "っ"}
    return out | IRREGULAR


@lru_cache(maxsize=1)
def keys() -> dict[str, str]:
    out = dict(KEYS)
    for key, letter in KEYS.items():
        if letter.translate(_VOICED) != letter:
            out[key + "@"] = letter.translate(_VOICED)
        if letter.translate(_POPPED) != letter:
            out[key + "["] = letter.translate(_POPPED)
    return out


def _swap(text: str, rows: dict[str, str]) -> str:
    pattern = re.compile("|".join(map(re.escape, sorted(rows, key=len, reverse=True))))
    return pattern.sub(lambda m: rows[m[0]], text)


def to_hiragana(text: str) -> str:
    """Longest spellings first; a doubled consonant gives the small stop."""
    text = re.sub(r"([bcdfghjkmpqrstvwxyz])(?=\1)", "っ", text)
    out = _swap(text, spellings())
    return re.sub("n(?![aiueoy])", "ん", out)


def to_spelling(text: str) -> str:
    back: dict[str, str] = {}
    for spelling, letters in spellings().items():
        if letters != "っ":
            back.setdefault(letters, spelling)
    out = _swap(text, back | {"ん": "n"})
    out = re.sub("っ([a-z])", r"\1\1", out).replace("っ", "ltu")
    return re.sub("([aiueo])ー", r"\1\1", out).replace("ー", "")


def convert(text: str, options: str) -> str:
    if "r" in options:
        text = to_hiragana(text)
    if "R" in options:
        text = to_spelling(text)
    if "K" in options:
        text = _swap(text, keys())
    if "k" in options:
        text = _swap(text, {v: k for k, v in reversed(list(keys().items()))})
    return text
