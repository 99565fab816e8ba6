"""Which encoding a text of bytes is in: one state machine for each encoding, run over the bytes of all texts of a batch.

A machine's table gives, for each state and byte, the next state and how much the byte speaks for the encoding: finished
hiragana, katakana and frequent kanji count for it, half-width katakana against it. Long texts are cut into pieces that the
machines enter in every state at once; the pieces' results are then joined, so time is linear and steps are as many as a
piece has bytes. A machine that ends in its error state rules its encoding out. Of those left the highest score wins, and of
equal scores the first in the order UTF-8, EUC-JP, SJIS.

Defined cases: byte order marks decide; null stays null; bytes below 0x80 only are ``JIS`` with an escape to a two-byte set,
else ``ASCII`` (the empty text too); zero bytes in every second, or three of four, places, or kana in pairs of bytes, are
UTF-16 or UTF-32 without a mark; what no machine takes is the default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER = ("UTF-8", "EUC-JP", "SJIS")
_MARKS = ((b"\xef\xbb\xbf", "UTF-8"), (b"\x00\x00\xfe\xff", "UTF-32be"), (b"\xff\xfe\x00\x00", "UTF-32le"), (b"\xfe\xff", "UTF-16be"), (b"\xff\xfe", "UTF-16le"))
_JIS = re.compile(rb"\x1b(?:\$[@B]|\$\([DOPQ]|&@\x1b\$B)")
_START, _ERROR, _STATES = 0, 9, 10
PIECE = 4096
#: Words for the encodings that Python's codecs know, for tests and queries.
CODECS = {"UTF-8": "utf-8", "EUC-JP": "euc_jp", "SJIS": "cp932", "JIS": "iso2022_jp", "UTF-16be": "utf-16-be", "UTF-16le": "utf-16-le", "UTF-32be": "utf-32-be", "UTF-32le": "utf-32-le"}


def _machine(*rules: tuple[int, int, int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Tables of next states and scores from rules (state, first byte, last byte, next state, score)."""
    to, score = np.full((_STATES, 256), _ERROR, np.uint8), np.zeros((_STATES, 256), np.int8)
    for state, low, high, then, points in rules:
        to[state, low : high + 1], score[state, low : high + 1] = then, points
    return to, score


def _utf8() -> tuple[np.ndarray, np.ndarray]:
    # 1 to 3: so many bytes more; 4 to 7: a second byte in a narrower range.
    more = [(n, 0x80, 0xBF, n - 1, 4 if n == 1 else 0) for n in (1, 2, 3)]
    first = [(0, 0, 0x7F, 0, 0), (0, 0xC2, 0xDF, 1, 0), (0, 0xE1, 0xEC, 2, 0), (0, 0xEE, 0xEF, 2, 0), (0, 0xF1, 0xF3, 3, 0), (0, 0xE0, 0xE0, 4, 0), (0, 0xED, 0xED, 5, 0), (0, 0xF0, 0xF0, 6, 0), (0, 0xF4, 0xF4, 7, 0)]
    return _machine(*first, *more, (4, 0xA0, 0xBF, 1, 0), (5, 0x80, 0x9F, 1, 0), (6, 0x90, 0xBF, 2, 0), (7, 0x80, 0x8F, 2, 0))


def _euc() -> tuple[np.ndarray, np.ndarray]:
    # 1 hiragana, 2 katakana, 3 frequent kanji, 4 other pairs, 5 half-width katakana, 6 the third set, 7 its last byte.
    first = [(0, 0, 0x7F, 0, 0), (0, 0xA1, 0xFE, 4, 0), (0, 0xA4, 0xA4, 1, 0), (0, 0xA5, 0xA5, 2, 0), (0, 0xB0, 0xCF, 3, 0), (0, 0x8E, 0x8E, 5, 0), (0, 0x8F, 0x8F, 6, 0)]
    return _machine(*first, (1, 0xA1, 0xF3, 0, 3), (2, 0xA1, 0xF6, 0, 3), (3, 0xA1, 0xFE, 0, 2), (4, 0xA1, 0xFE, 0, 0), (5, 0xA1, 0xDF, 0, -2), (6, 0xA1, 0xFE, 7, 0), (7, 0xA1, 0xFE, 0, 0))


def _sjis() -> tuple[np.ndarray, np.ndarray]:
    # 1 hiragana's row, 2 katakana's, 3 frequent kanji, 4 other pairs.
    first = [(0, 0, 0x7F, 0, 0), (0, 0xA1, 0xDF, 0, -2), (0, 0x81, 0x9F, 4, 0), (0, 0xE0, 0xFC, 4, 0), (0, 0x82, 0x82, 1, 0), (0, 0x83, 0x83, 2, 0), (0, 0x88, 0x97, 3, 0)]
    second = [(s, low, high, 0, 2 if s == 3 else 0) for s in (1, 2, 3, 4) for low, high in ((0x40, 0x7E), (0x80, 0xFC))]
    return _machine(*first, *second, (1, 0x9F, 0xF1, 0, 3), (2, 0x40, 0x7E, 0, 3), (2, 0x80, 0x96, 0, 3))


_TO, _SCORE = (np.stack(x) for x in zip(_utf8(), _euc(), _sjis(), strict=True))


def run_machines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """End states and scores, a row for each text and a column for each machine."""
    piece_of = [(i, at) for i, t in enumerate(texts) for at in range(0, max(1, len(t)), PIECE)]
    owner = np.array([i for i, _ in piece_of])
    sizes = np.array([min(PIECE, len(texts[i]) - at) for i, at in piece_of])
    order = np.argsort(-sizes, kind="stable")
    data = np.zeros((int(sizes.max(initial=0)), len(piece_of)), np.uint8)
    for column, k in enumerate(order.tolist()):
        i, at = piece_of[k]
        data[: sizes[k], column] = np.frombuffer(texts[i], np.uint8, sizes[k], at)
    machines = len(ORDER)
    # [machine, state it was entered in, piece]: where it is now, and its points.
    state = np.broadcast_to(np.arange(_STATES, dtype=np.uint8)[None, :, None], (machines, _STATES, len(piece_of))).copy()
    points = np.zeros(state.shape, np.int32)
    which = np.arange(machines)[:, None, None]
    left = -np.sort(-sizes)
    for step in range(len(data)):
        n = int(np.searchsorted(-left, -step, "left"))  # pieces that still have a byte
        now, byte = state[:, :, :n], data[step, :n][None, None, :]
        points[:, :, :n] += _SCORE[which, now, byte]
        state[:, :, :n] = _TO[which, now, byte]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    end, total = np.zeros((len(texts), machines), np.uint8), np.zeros((len(texts), machines), np.int64)
    m = np.arange(machines)
    for k, i in enumerate(owner.tolist()):
        entered = end[i].copy()
        total[i] += points[m, entered, place[k]]
        end[i] = state[m, entered, place[k]]
    return end, total


def _wide(text: bytes) -> str | None:
    """UTF-16 or UTF-32 without a mark, by where zero bytes are, or by pairs of kana and kanji that have none."""
    if len(text) < 4 or len(text) % 2:
        return None
    if b"\0" not in text:
        pairs = np.frombuffer(text, np.uint8).reshape(-1, 2)
        for name, high, low in (("UTF-16be", pairs[:, 0], pairs[:, 1]), ("UTF-16le", pairs[:, 1], pairs[:, 0])):
            kana = (high == 0x30) & (low >= 0x41)
            if not text.isascii() and kana.mean() > 0.15 and (kana | (high == 0x30) | ((high >= 0x4E) & (high <= 0x9F)) | (high == 0xFF)).mean() > 0.9:
                return name
        return None
    zero = np.frombuffer(text, np.uint8) == 0
    if len(text) % 4 == 0:
        share = zero.reshape(-1, 4).mean(0)
        if share[0] > 0.9 and share[1] > 0.9 and share[3] < 0.5:
            return "UTF-32be"
        if share[3] > 0.9 and share[2] > 0.9 and share[0] < 0.5:
            return "UTF-32le"
    even, odd = zero.reshape(-1, 2).mean(0)
    return "UTF-16be" if even > odd else "UTF-16le" if odd > even else None


def detect(texts: list[bytes | None], default: str = "ASCII") -> list[str | None]:
    """The name of each text's encoding."""
    out: list[str | None] = [None] * len(texts)
    open_ = []
    for i, text in enumerate(texts):
        if text is None:
            continue
        mark = next((name for m, name in _MARKS if text.startswith(m)), None)
        if mark or (mark := _wide(text)):
            out[i] = mark
        elif text.isascii():
            out[i] = "JIS" if _JIS.search(text) else "ASCII"
        else:
            open_.append(i)
    end, total = run_machines([texts[i] for i in open_]) if open_ else (None, None)
    for k, i in enumerate(open_):
        fits = [m for m in range(len(ORDER)) if end[k, m] == _START]
        out[i] = ORDER[max(fits, key=lambda m: (total[k, m], -m))] if fits else default
    return out


def detected(column: Column, default: str = "ASCII") -> Column:
    """The encoding of a binary column's texts."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = [bytes(x) if x is not None else None for x in batch]
            out, held, size = [], [], 0
            for text in texts:  # groups of some megabytes, so that memory does not follow the batch
                held.append(text)
                size += len(text or b"")
                if size > 4_000_000:
                    out, held, size = out + detect(held, default), [], 0
            yield pd.Series(out + detect(held, default), dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(column)


def encoded(column: Column, name: Column) -> Column:
    """A text's bytes in the named encoding; characters that it lacks are question marks."""

    def run(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([t.encode(CODECS.get(n, n), "replace") if t is not None else None for t, n in zip(texts, names, strict=True)], dtype=object)

    return F.pandas_udf(run, "binary")(column, name)
