"""Readings of titles: how a kanji title is pronounced, as its article states it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import wikitext as w
from ..functions.charclass import ALNUM, ELISION, HIRAGANA, KANJI, KATAKANA, SPACE, TRIM, has, only
from ..functions.kana import convert

# A reading ends at the first of these.
CUTS = ("{{", "、", "。", "；", ";", ",", "，", "[", "]", "&", "(", "（", "&gt;", "<")
# Infobox names of readings and of other names.
READING_KEYS = ("ふりがな", "よみがな")
ALIAS_KEYS = ("名前", "NAME", "name", "Name")
# Marks that separate several infobox readings, tried in this order.
SEVERAL = ("、", "・", ",", "，")

_KANJI_RUN = re.compile(f"[{KANJI}]+")
_OTHER_RUN = re.compile(f"[^{KANJI}]+", re.S)
_KATAKANA_RUN = re.compile(f"[{KATAKANA}]+")
_ODD = re.compile(f"[{KANJI}{ALNUM}]")
# A word, and if a space follows, all that still looks like kana.
_SPOKEN = re.compile(f"[{SPACE}]*([^{SPACE}]?[^{SPACE}]*(?:[{SPACE}][{SPACE}{HIRAGANA}{KATAKANA}{ELISION}]*)?)", re.S)
_BRACKETED = re.compile(r"\[|\]|[(（「【]")
_CLOSE = re.compile("[)）」】]")


def script_switch(title: str) -> tuple[int, int]:
    """(start of the part without kanji, start of the kanji part): 0 for what the title begins with, -1 for what is missing."""
    if _KANJI_RUN.match(title):
        m = _OTHER_RUN.search(title, 1)
        return (m.start() if m else -1), 0
    m = _KANJI_RUN.search(title, 1)
    return 0, (m.start() if m else -1)


def cut_at(text: str, mark: str) -> str:
    return text.split(mark, 1)[0]


def longest_piece(text: str, mark: str) -> str:
    """The longest piece between marks, the first of equals."""
    return max(text.split(mark), key=len)


def longest_piece_column(text: Column, mark: str) -> Column:
    return F.aggregate(F.split(text, re.escape(mark), -1), F.lit(""), lambda best, piece: F.when(F.char_length(piece) > F.char_length(best), piece).otherwise(best))


def spoken_part(text: str) -> str:
    """Up to the first space, and on if kana or elision marks follow it."""
    return _SPOKEN.match(text)[1].strip(TRIM)


def clean_reading(title: str, text: str) -> str:
    for mark in CUTS:
        text = cut_at(text, mark)
    if only(title, "kanji"):
        for mark in ("・",) * (len(title) <= 2) + ("/", "／"):
            text = longest_piece(text, mark) if text else ""
    text = spoken_part(cut_at(text, "|"))
    return text.translate(dict.fromkeys(map(ord, " 　'")))


def bracket_after(text: str, needle: str) -> str:
    """Inside of the first bracket behind the needle and outside links; opening and closing kinds need not agree."""
    at = text.find(needle)
    if at < 0:
        return ""
    depth = 0
    for m in _BRACKETED.finditer(text, at + len(needle)):
        if m[0] == "[":
            depth += 1
        elif m[0] == "]":
            depth -= 1
        elif depth < 1:
            end = _CLOSE.search(text, m.end())
            return text[m.end() : end.start() if end else None]
    return ""


def early_span(text: str, opening: str, closing: str) -> str:
    """First span of two marks, if it opens within the first hundred characters."""
    a, mark, rest = text.partition(opening)
    inside, end, _ = rest.partition(closing)
    return inside if mark and end and len(a) < 100 else ""


def boxed_reading(head: str, **tags) -> str:
    text = next((v for key in READING_KEYS if (v := w.infobox(head, key, **tags))), "")
    text = w.snip(text, "&lt;", "&gt;")
    return next((text[: text.find(m)] for m in SEVERAL if m in text), text)


def elision_at(reading: str) -> int:
    """Place of an elision mark at the start or the very end; -1 for none."""
    m = re.search(f"[{ELISION}]", reading)
    if len(reading) <= 1 or not m or (m.start() and m.start() < len(reading) - 1):
        return -1
    return m.start()


def complete(title: str, reading: str, mark: int, kana_at: int, kanji_at: int) -> str:
    """The half of a reading that an elision mark leaves out, taken from the title."""
    if mark == 0:
        return title[:kanji_at] + reading[1:].strip(TRIM)
    return reading[:mark] + title[kana_at:].strip(TRIM)


def plausible(title: str, reading: str) -> bool:
    """No kanji, letters or digits; and unless elided, some katakana run of the title is heard in it."""
    if not reading or _ODD.search(reading):
        return False
    runs = _KATAKANA_RUN.findall(title)
    if elision_at(reading) >= 0 or not runs:
        return True
    heard = convert(reading, "KC")
    return any(run in heard for run in runs)


def spaced(title: str) -> list[str]:
    """The title with one space put in, at every place, half-width and full-width."""
    return [title[:i] + s + title[i:] for i in range(1, len(title)) for s in " 　"]


def _stated(title: str, lead: str, head: str, **tags) -> str:
    # The title bold or italic with a bracket behind it; then with a space in it; then the infobox.
    for name in (title, *spaced(title)):
        for quote in ("'''", "''"):
            needle = quote + name + quote
            if needle in lead:
                found = clean_reading(title, bracket_after(lead, needle))
                if plausible(title, found):
                    return found
    found = clean_reading(title, boxed_reading(head, **tags))
    return found if plausible(title, found) else ""


def find_reading(title: str, inner: str, *, whole: str = "", **tags) -> str:
    """The first plausible reading, from the surest place to the least sure. ``whole`` is the title with its parentheses, as a lead may have it."""
    lead, head = w.lead_of(inner, **tags), w.head_of(inner, **tags)
    found = _stated(title, lead, head, **tags)
    if not found and (whole := w.clean(whole)) and whole != title:
        found = _stated(whole, lead, head, **tags)
    if found:
        return found
    alias = next((v for key in ALIAS_KEYS if (v := w.infobox(head, key, **tags))), "")
    if alias and alias != title:
        found = _stated(alias, lead, head, **tags)
        if found:
            return found
    for place in (bracket_after(lead, "'''"), early_span(lead, "'''", "'''"), early_span(lead, "{{音声ルビ|", "}}")):
        found = clean_reading(title, place)
        if plausible(title, found):
            return found
    return ""


def reading(title: str, inner: str, whole: str = "", *, raw_tags: bool = False) -> str:
    """Reading of a title; empty if none is found. A title in kana is its own reading. ``whole`` as in ``find_reading``."""
    kana_at, kanji_at = script_switch(title)
    if kanji_at < 0 and only(title, "kana"):
        return w.plain_reading(title)
    found = find_reading(title, inner, whole=whole, raw_tags=raw_tags)
    if found and kanji_at >= 0 and kana_at >= 0:
        mark = elision_at(found)
        if mark >= 0:
            found = complete(title, found, mark, kana_at, kanji_at)
    return w.plain_reading(found)


def has_kana(text: str) -> bool:
    return has(text, "hiragana") or has(text, "katakana")


def japanese_length(text: str) -> int:
    """How many characters are kanji or kana."""
    return len(re.findall(f"[{KANJI}{HIRAGANA}{KATAKANA}]", text))
