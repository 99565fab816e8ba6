"""English words for katakana titles, and readings for Latin ones."""

from __future__ import annotations

import re

from ..functions import wikitext as w
from ..functions.charclass import ALNUM, ALPHA, KANJI, SPACE, only
from .readings import cut_at, find_reading

# Affixes that are no part of the word, and marks that end it.
AFFIXES = ("Republic of ", "Kingdom of ", "State of ", "The ", " Corporation", " Corp", "[[w:")
CUTS = ("、", "；", ";", ",", "，", "[", "]", "&", "(", "（")
# What introduces an English word, what ends it, and what of the introduction is ignored in the mis-hit test.
MARKERS = (
    ("{{lang-en-short|", "}}", ""), ("{{Lang-en-short|", "}}", ""), ("[[:en:", "]]", ""), ("{{Lang-en|", "}}", ""), ("{{lang-en|", "}}", ""),
    ("{{Lang|en|", "}}", ""), ("{{lang|en|", "}}", ""), ("{{en|", "}}", ""), ("{{EN|", "}}", ""),
    ("（[[英語]]：", "）", "[[英語]]："), ("（[[英語]]:", "）", "[[英語]]:"), ("（英語：", "）", "英語："), ("（英語:", "）", "英語:"),
    ("（英：", "）", "英："), ("（英:", "）", "英:"), ("（[[英語|英]]：", "）", "（[[英語|英]]："), ("（[[英語|英]]:", "）", "（[[英語|英]]:"),
    ("（[[w:", "）", "（[[w:"), ("（\"", "\"）", ""), ("（&quot;", "&quot;", ""),
)
# Words near which an English word is stated, tried after the title itself.
NAMES = ("英語表記", "英語名", "英称", "英語圏の[[姓]]", "英語圏の[[名]]", "[[英語]]では", "英語では")
# Kana at a title's start and the letters that an English word for it may start with.
INITIALS = {
    "あ": "auio", "い": "iey", "う": "uwov", "え": "amxefshl", "お": "oa", "か": "kc", "き": "kcx", "く": "kcxq", "け": "kcxq", "こ": "kc",
    "さ": "sct", "し": "stc", "す": "st", "せ": "sc", "そ": "s", "た": "t", "ち": "tc", "つ": "t", "て": "t", "と": "t",
    "な": "nk", "に": "n", "ぬ": "n", "ね": "n", "の": "n", "は": "h", "ひ": "h", "ふ": "fpv", "へ": "h", "ほ": "h",
    "ま": "m", "み": "m", "む": "m", "め": "m", "も": "m", "や": "yj", "ゆ": "yeju", "よ": "y",
    "ら": "rl", "り": "rl", "る": "rl", "れ": "rl", "ろ": "rl", "わ": "wo", "を": "w", "ん": "n",
    "が": "g", "ぎ": "g", "ぐ": "g", "げ": "g", "ご": "g", "ざ": "tzxs", "じ": "gjzt", "ず": "z", "ぜ": "zjx", "ぞ": "z",
    "だ": "d", "ぢ": "dj", "づ": "z", "で": "d", "ど": "d", "ば": "b", "び": "bv", "ぶ": "b", "べ": "bv", "ぼ": "b",
    "ぱ": "p", "ぴ": "p", "ぷ": "p", "ぺ": "p", "ぽ": "p", "ヴ": "v",
}

_NOT_WORD = re.compile(f"[^{ALPHA}{SPACE}-]")
_STEP_BACK = re.compile(f"[{ALNUM}{SPACE}|\\-:{{(（「]")
_KANJI = re.compile(f"[{KANJI}]")
_LEADING = re.compile(f"[{SPACE}=\\[(「]*([{ALPHA}{SPACE}]*)")
# Behind the searched term: a closing mark or space, a particle or space, punctuation or space.
_LINK_TO_WORD = re.compile(f"(?:[』）)]|\\]\\]|[{SPACE}])?(?:は|の|であり|[{SPACE}])?(?:[、,:：]|[{SPACE}])?")
_BRACKETS = (("（", "）"), ("「", "」"), ("(", ")"), ("'''", "'''"), ("''", "''"))


def clean_word(text: str) -> str:
    text = w.snip(text, "{{", "}}")
    for affix in AFFIXES:
        text = text.replace(affix, " ")
    for mark in CUTS:
        text = cut_at(text, mark)
    return _NOT_WORD.sub("", cut_at(text.replace("'", ""), "|")).strip(" 　")


def stated_word(text: str) -> str:
    """The word of a span, if it stands there as it is: letters that other characters part are no word, even if they occur elsewhere."""
    word = clean_word(text)
    return word if word in text else ""


def fits_initial(title: str, word: str) -> bool:
    """Whether an English word may stand for a title, by their first letters; words of one or two letters never do."""
    if not title or len(word) <= 2:
        return False
    first = title[0]
    kana = chr(ord(first) - 0x60) if "ァ" <= first <= "ン" else first
    letters = INITIALS.get(kana)
    return letters is None or word[0].lower() in letters


def misses(title: str, term: str, text: str, word: str) -> bool:
    """Whether a word found near a term is not the title's: only found in the term, kanji right before it, or another initial."""
    rest = text.replace(term, "　　　") if term else text
    at = rest.find(word)
    if at < 0:
        return True
    while at > 0 and _STEP_BACK.match(rest, at):
        at -= 1
    # Only a line's or sentence's end right here shields from kanji further ahead.
    reach = max(at - 10, 0)
    before = rest[at : at + 1] if rest[at : at + 1] in ("\n", "。") else rest[reach + 1 : at + 1]
    return bool(_KANJI.search(before)) or not fits_initial(title, word)


def marked_word(text: str, start: str, end: str) -> str:
    """The word behind a mark, up to its end or a bar."""
    at = text.find(start)
    if at < 0:
        return ""
    at += len(start)
    stops = [p for p in (text.find("|", at), text.find(end, at)) if p >= 0]
    return stated_word(text[at : min(stops)]) if stops else ""


def leading_word(text: str) -> str:
    """The run of letters at the start, without its last character."""
    return clean_word(_LEADING.match(text)[1][:-1])


def by_markers(title: str, term: str, text: str) -> str:
    for start, end, ignored in MARKERS:
        word = marked_word(text, start, end)
        if word and not misses(title, term, text.replace(ignored, "") if ignored else text, word):
            return word
    word = leading_word(text)
    return word if word and not misses(title, term, text, word) else ""


def near(title: str, term: str, text: str) -> str:
    """The word in a bracket right behind a term, or marked somewhere after it."""
    start = text.find(term)
    if start < 0:
        return ""
    at = _LINK_TO_WORD.match(text, start + len(term)).end()
    word = ""
    for a, b in _BRACKETS:
        # A quote mark with its like before the term ends the term's own quote and opens nothing.
        if text.startswith(a, at) and not (a[0] == "'" and text.endswith(a, 0, start)):
            word = stated_word(text[at + len(a) :].split(b, 1)[0])
            break
    if word and not misses(title, term, text, word):
        return word
    rest = text[at:]
    word = by_markers(title, term, rest)
    return word if word and not misses(title, term, rest, word) else ""


def near_plain_or_bold(title: str, term: str, text: str) -> str:
    return near(title, term, text) or near(title, f"'''{term}'''", text)


def _by_names(title: str, text: str) -> str:
    return next((found for term in (title, *NAMES) if (found := near_plain_or_bold(title, term, text))), "")


def english_word(title: str, inner: str, *, raw_tags: bool = False) -> str:
    """English word for a katakana title: coined words first, then infobox, lead, etymology, and marks anywhere."""
    parts = inner.split("\n==")
    lead = w.clean(w.drop_blocks("\n==".join(parts[:2])), raw_tags=raw_tags)
    head = w.head_of(inner, raw_tags=raw_tags)
    tries = (
        lambda: near_plain_or_bold(title, "和製英語", lead),
        lambda: near_plain_or_bold(title, "英語名", head),
        lambda: near_plain_or_bold(title, "英名", head),
        lambda: _by_names(title, lead),
        lambda: _by_names(title, section) if (section := w.section(inner, "語源")) else "",
        lambda: by_markers(title, title, lead),
    )
    return next((found for attempt in tries if (found := attempt())), "")


def english_pair(title: str, inner: str, *, raw_tags: bool = False) -> tuple[str, str] | None:
    """(reading, English) of a title in katakana or in Latin letters; None for others."""
    if only(title, "katakana"):
        return w.plain_reading(title), english_word(title, inner, raw_tags=raw_tags)
    if only(title, "alpha"):
        found = w.plain_reading(find_reading(title, inner, raw_tags=raw_tags))
        return ("" if misses(found, "", title, title) else found), title
    return None
