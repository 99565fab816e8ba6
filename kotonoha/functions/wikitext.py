"""Wikitext kernels over Python strings: spans, tags, infobox values, sections, lead text.

They are positional and nested, which expressions of the JVM cannot state; the plans run them in Arrow UDFs, many to one
call. Bodies are escaped as in dumps (``&lt;ref&gt;``). ``raw_tags`` also treats unescaped tags, for hand-made texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .charclass import SPACE, TRIM

# Brackets that reverse and forward scans look for, in order of preference at equal places. Fixed values.
FORWARD = (("'''", "'''"), ("''", "''"), ("「", "」"), ("『", "』"), ("[[", "]]"), ("（", "）"), ("(", ")"))
BACKWARD = (("'''", "'''"), ("「", "」"), ("『", "』"), ("[[", "]]"), ("（", "）"), ("(", ")"))
OPENERS = "「『（(['"


_SLICE = 128  # rows of a batch that are Python strings at a time


def slices(columns: tuple[pa.Array, ...]) -> Iterator[list[tuple]]:
    """The rows of a batch of Arrow columns in pieces, so that a task's memory does not follow the size of its batches."""
    for at in range(0, len(columns[0]), _SLICE):
        yield list(zip(*[c.slice(at, _SLICE).to_pylist() for c in columns], strict=True))


@lru_cache(maxsize=256)
def _either(opening: str, closing: str) -> re.Pattern:
    return re.compile(f"({re.escape(closing)})|{re.escape(opening)}")


def closing_of(text: str, opening: str, closing: str, pos: int) -> int:
    """Place of the closing mark that balances an opening one which ended at ``pos``; -1 if there is none."""
    depth = 1
    for m in _either(opening, closing).finditer(text, pos):
        depth += -1 if m[1] else 1
        if not depth:
            return m.start()
    return -1


def bracket(text: str, opening: str, closing: str, pos: int = 0, end: int | None = None, *, anywhere: bool = True) -> tuple[int, int, int, int] | None:
    """(open, inside, close, after) of the first balanced bracket from ``pos`` that closes before ``end``."""
    end = len(text) if end is None else end
    at = text.find(opening, pos)
    if at < 0 or at >= end or not (anywhere or at == pos):
        return None
    inside = at + len(opening)
    close = closing_of(text, opening, closing, inside)
    return None if close < 0 or close >= end else (at, inside, close, close + len(closing))


def bracket_back(text: str, opening: str, closing: str, pos: int, end: int = 0, *, anywhere: bool = True) -> tuple[int, int, int, int] | None:
    """The same leftwards: the last closing mark at or before ``pos`` and the opening one, not before ``end``, that balances it."""
    close = text.rfind(closing, 0, pos + len(closing))
    if close < 0 or (close < end if anywhere else close != pos):
        return None
    depth, cursor = 1, close
    while depth:
        at = text.rfind(opening, 0, cursor)
        if at < 0 or at < end:
            return None
        inner = text.rfind(closing, 0, cursor)
        if opening != closing and inner > at:
            depth, cursor = depth + 1, inner
        else:
            depth, cursor = depth - 1, at
    return cursor, cursor + len(opening), close, close + len(closing)


def first_of(text: str, marks: tuple[str, ...], pos: int = 0, end: int | None = None) -> tuple[int, int, int] | None:
    """(start, end, number) of the mark that comes first; of several at one place the one listed first."""
    end = len(text) if end is None else end
    hits = [(at, k) for k, mark in enumerate(marks) if mark and 0 <= (at := text.find(mark, pos)) < end]
    if not hits:
        return None
    at, k = min(hits)
    return at, at + len(marks[k]), k


def last_of(text: str, marks: tuple[str, ...], pos: int, end: int) -> tuple[int, int, int] | None:
    """(start, end, number) of the mark that starts last, at or before ``pos`` and behind ``end``.

    A later listed mark also wins if it reaches behind the start of the one found so far.
    """
    best = None
    for k, mark in enumerate(marks):
        at = text.rfind(mark, 0, pos + len(mark)) if mark else -1
        if at > end and (best is None or at + len(mark) > best[0]):
            best = (at, at + len(mark), k)
    return best


def any_bracket(text: str, pos: int = 0, end: int | None = None, *, anywhere: bool = True) -> tuple[int, int, int, int] | None:
    """The bracket of any kind that opens first. A bold mark that does not close is tried as an italic one."""
    hit = first_of(text, tuple(a for a, _ in FORWARD), pos, end)
    if not hit:
        return None
    kinds = (0, 1) if hit[2] == 0 else (hit[2],)
    return next((found for k in kinds if (found := bracket(text, *FORWARD[k], pos, end, anywhere=anywhere))), None)


def any_bracket_back(text: str, pos: int, end: int = 0, *, anywhere: bool = True) -> tuple[int, int, int, int] | None:
    hit = last_of(text, tuple(b for _, b in BACKWARD), pos, end)
    return bracket_back(text, *BACKWARD[hit[2]], pos, end, anywhere=anywhere) if hit else None


def snip(text: str, opening: str, closing: str, *, once: bool = False) -> str:
    """Without balanced spans. Of one that never closes only the opening mark goes, and nothing after it is looked at."""
    out, pos = [], 0
    while (at := text.find(opening, pos)) >= 0:
        out.append(text[pos:at])
        inside = at + len(opening)
        close = closing_of(text, opening, closing, inside)
        if close < 0:
            # The text goes on behind the last closing mark, if the unclosed span holds any.
            last = text.rfind(closing, inside)
            return "".join(out) + text[inside if last < 0 else last + len(closing) :]
        pos = close + len(closing)
        if once:
            break
    return "".join(out) + text[pos:]


def drop_tag_marks(text: str, name: str, *, raw_tags: bool = False) -> str:
    """Without the tags of an element; what they enclose stays."""
    pairs = (("&lt;", "&gt;"), ("<", ">"))[: 1 + raw_tags]
    for a, b in pairs:
        for form in (f"{a}{name} /{b}", f"{a}{name}/{b}", f"{a}{name}{b}", f"{a}/{name}{b}"):
            text = text.replace(form, "")
    return text


def drop_elements(text: str, name: str, *, raw_tags: bool = False) -> str:
    """Without an element and what it encloses; also the self-closing form. A tag that never closes stays."""
    for a, b in (("&lt;", "&gt;"), ("<", ">"))[: 1 + raw_tags]:
        start = re.compile(re.escape(a + name) + "(?![A-Za-z0-9])")
        token = re.compile(f"({re.escape(a + name)}(?![A-Za-z0-9]))|({re.escape(f'{a}/{name}{b}')})|(/{re.escape(b)})")
        out, pos = [], 0
        while m := start.search(text, pos):
            depth, end = 1, -1
            for t in token.finditer(text, m.end()):
                depth += 1 if t[1] else -1
                if not depth:
                    end = t.end()
                    break
            if end < 0:
                break
            out.append(text[pos : m.start()])
            pos = end
        text = "".join(out) + text[pos:]
    return text


def clean(text: str, *, raw_tags: bool = False) -> str:
    """The standard cleaner: entities, line breaks, comments, notices, images, references, remaining tags, spaces."""
    text = text.replace("&quot;", "").replace("&amp;", "&")
    for name in ("br", "small"):
        text = drop_tag_marks(text, name, raw_tags=raw_tags)
    # Spans that the cleaner removes.
    for a, b in (("&lt;!--", "--&gt;"), ("\n{{独自研究", "}}"), ("\n{{大言壮語", "}}"), ("\n{{出典の明記", "}}"), ("\n[[Image:", "]]"), ("\n[[image:", "]]"), ("\n[[ファイル:", "]]")):
        text = snip(text, a, b)
    for name in ("ref", "span"):
        text = drop_elements(text, name, raw_tags=raw_tags)
    return snip(text, "&lt;", "&gt;").replace("  ", " ").strip(TRIM)


def snip_closed(text: str, opening: str, closing: str) -> str:
    """Without balanced spans. An opening mark that never closes stays, and what follows it is looked at."""
    out, pos = [], 0
    while (at := text.find(opening, pos)) >= 0:
        close = closing_of(text, opening, closing, at + len(opening))
        out.append(text[pos : at if close >= 0 else at + len(opening)])
        pos = close + len(closing) if close >= 0 else at + len(opening)
    return "".join(out) + text[pos:]


def strip_disambiguation(text: str) -> str:
    """A title without parentheses, cleaned; one that is cut within a parenthesis keeps it."""
    return snip_closed(clean(snip_closed(text, "(", ")")), "（", "）").strip(TRIM + "'")


def without_links(text: str) -> str:
    return text.replace("[[", "").replace("]]", "")


def without_et_cetera(text: str) -> str:
    return text.removesuffix("など")


def head_of(inner: str, *, raw_tags: bool = False) -> str:
    """What stands before the first heading, cleaned: here infoboxes are looked up."""
    return clean(inner.split("\n==", 1)[0], raw_tags=raw_tags)


def drop_blocks(text: str) -> str:
    """Without templates, links and tables that start a line or the page, again and again until nothing changes."""
    while True:
        before = len(text)
        for a, b in (("{{", "}}"), ("[[", "]]"), ("{|", "|}")):
            for lead in (">", "\n"):
                at = text.find(lead + a)
                if at >= 0:
                    text = text[: at + 1] + snip(text[at + 1 :], a, b, once=True)
        if len(text) == before or not text:
            return text


def lead_of(inner: str, *, raw_tags: bool = False) -> str:
    """The text up to the first heading (with its mark), without blocks, cleaned."""
    text = clean(drop_blocks(inner), raw_tags=raw_tags)
    at = text.find("\n==")
    return (text if at < 0 else text[: at + 3]).replace("  ", " ").strip(TRIM)


# What may open an infobox.
_BOXES = (">{{Infobox", "\n{{Infobox", ">{|", "\n{|", ">{{", "\n{{", "{{")


def infobox(head: str, key: str, *, raw_tags: bool = False) -> str:
    """Value of the parameter whose name ends with ``key``; empty if there is none or the value never ends.

    Names are looked for behind a bar and before a line's end, an equals sign, a bar or a link. At a bracket the scan moves
    on to the line feed behind the last mark it saw, as values with brackets may hold bars.
    """
    hit = first_of(head, _BOXES)
    seen, pos = (hit[0], hit[1]) if hit else (0, 0)
    end, value = len(head), -1
    while value < 0:
        if pos >= end:
            return ""
        if head[pos] in "([{":
            pos = head.find("\n", seen)
            if pos < 0:
                return ""
        hit = first_of(head, ("|", "[[", "{{"), pos)
        if not hit:
            return ""
        seen, pos = hit[0], hit[1]
        if hit[2]:
            continue
        hit = first_of(head, (key, "=", "|", "[[", "\n"), pos)
        if not hit:
            return ""
        seen, pos = hit[0], hit[1]
        if hit[2]:
            continue
        while pos < end and head[pos] in SPACE:
            pos += 1
        if pos < end and head[pos] == "=":
            value = pos = pos + 1
    while True:
        if pos >= end:
            return ""
        if head[pos] in "([":
            pos = head.find("\n", seen)
            if pos < 0:
                return ""
        hit = first_of(head, ("|", "\n", "[["), pos)
        if not hit:
            return ""
        seen, pos = hit[0], hit[1]
        if hit[2] < 2:
            break
    text = head[value : max(value, pos - 1)]
    for a, b in (("(", ")"), ("（", "）"), ("{{", "}}"), ("{|", "|}")):
        text = snip(text, a, b)
    text = text.replace("&amp;", "&")
    for name in ("ref", "span"):
        text = drop_elements(text, name, raw_tags=raw_tags)
    for name in ("sup", "br", "quot"):
        text = drop_tag_marks(text, name, raw_tags=raw_tags)
    return without_et_cetera(snip(text, "&lt;!--", "--&gt;").strip(SPACE + "'"))


def _section(inner: str, name: str) -> tuple[int, int] | None:
    """Start of a section's heading (levels 2 and 3) and of the next heading of level 2; -1 for none."""
    starts = (inner.find(f"\n{m}{s}{name}{s}{m}\n") for m in ("==", "===") for s in (" ", ""))
    start = next((at for at in starts if at >= 0), -1)
    if start < 0:
        return None
    m = re.compile("\n==(?!=)").search(inner, start + 3 + len(name))
    return start, m.start() if m else -1


def section(inner: str, name: str) -> str:
    """A section with its heading; empty if it is missing or the last one."""
    found = _section(inner, name)
    return "" if not found or found[1] < 0 else inner[found[0] : found[1]]


def cut_section(inner: str, name: str) -> str:
    found = _section(inner, name)
    return inner if not found else inner[: found[0]] + (inner[found[1] :] if found[1] >= 0 else "")


def plain_reading(text: str) -> str:
    return text.translate(dict.fromkeys(map(ord, " -_・=＝")))


# ---------------------------------------------------------------- native forms


def first_of_column(text: Column, *marks: str) -> Column:
    """The place, from 1, of the mark that comes first; null where there is none."""
    return F.least(*[F.nullif(F.instr(text, mark), F.lit(0)) for mark in marks]) if len(marks) > 1 else F.nullif(F.instr(text, marks[0]), F.lit(0))


def snip_column(text: Column, opening: str, closing: str) -> Column:
    """``snip`` as a column. Only texts in which a span holds another, or does not close, go to Python."""
    pieces = F.split(text, re.escape(opening), -1)
    rest = F.slice(pieces, F.lit(2), F.size(pieces))
    plain = F.forall(rest, lambda p: F.contains(p, F.lit(closing)))
    cut = F.transform(rest, lambda p: F.substr(p, F.instr(p, closing) + len(closing)))

    def nested(texts: pd.Series) -> pd.Series:
        return pd.Series([snip(x, opening, closing) if x is not None else None for x in texts], dtype=object)

    scanned = F.pandas_udf(nested, "string")(F.when(plain, None).otherwise(text))
    return F.when(plain, F.concat(F.element_at(pieces, 1), F.array_join(cut, ""))).otherwise(scanned)
