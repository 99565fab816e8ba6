"""Encodings: machines against Python's codecs, all encodings detected, ties and odd bytes."""

import random

import numpy as np
import pytest

from kotonoha.functions import encodings as e

TEXTS = ["これは日本語の文章です。漢字とカタカナを含みます。", "吾輩は猫である", "カタカナ abc ひらがな", "東京都と京都府の人口は多い。" * 900]


@pytest.mark.parametrize("name", [*e.CODECS])
@pytest.mark.parametrize("text", TEXTS)
def test_all_encodings_are_detected(name, text):
    assert e.detect([text.encode(e.CODECS[name])]) == [name]


def test_marks_and_plain_bytes():
    marked = ["あ".encode("utf-8-sig"), b"\xfe\xff\x30\x42", b"\xff\xfe\x42\x30", b"\x00\x00\xfe\xff\x00\x00\x30\x42", b"\xff\xfe\x00\x00\x42\x30\x00\x00", b"", b"abc\x1b[0m", None]
    assert e.detect(marked) == ["UTF-8", "UTF-16be", "UTF-16le", "UTF-32be", "UTF-32le", "ASCII", "ASCII", None]
    assert e.detect([b"\xff\xff\xff", b"abc\x80"], "none") == ["none", "none"]
    assert e.detect(["ｱｲｳ".encode("cp932"), "é".encode()]) == ["SJIS", "UTF-8"]


def brute(text, machine):
    state, points = 0, 0
    for byte in text:
        points += int(e._SCORE[machine, state, byte])
        state = int(e._TO[machine, state, byte])
    return state, points


def test_pieces_join_to_the_whole(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choice([0x41, 0x82, 0xA0, 0xA4, 0xE3, 0x81, 0x8E, 0xB0, 0xC3, 0xF0]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += ["ひらがな漢字".encode(c) * 5 for c in ("utf-8", "cp932", "euc_jp")]
    monkeypatch.setattr(e, "PIECE", 7)
    end, total = e.run_machines(texts)
    for i, text in enumerate(texts):
        assert [(int(end[i, m]), int(total[i, m])) for m in range(3)] == [brute(text, m) for m in range(3)]


@pytest.mark.parametrize("name, machine", [("utf-8", 0), ("euc_jp", 1), ("cp932", 2)])
def test_machines_take_what_codecs_take(name, machine):
    rng = np.random.default_rng(5)
    pool = "あいうえおんァヴ亜熙々。ｱﾝabc\n"
    texts = ["".join(rng.choice(list(pool), 30)).encode(name) for _ in range(50)]
    end, _ = e.run_machines(texts + [t[:-1] + b"\xff" for t in texts])
    assert (end[:50, machine] == 0).all() and (end[50:, machine] != 0).all()
    if name == "utf-8":
        for _ in range(300):
            text = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F], 4).tolist())
            try:
                text.decode()
                good = True
            except UnicodeDecodeError:
                good = False
            assert (e.run_machines([text])[0][0, 0] == 0) == good


def test_column(spark):
    from pyspark.sql import functions as F

    rows = [(i, t, n) for i, (t, n) in enumerate((t, n) for t in TEXTS for n in e.CODECS)] + [(99, None, "SJIS")]
    df = spark.createDataFrame(rows, "i int, t string, n string")
    got = df.select("n", "t", e.detected(e.encoded(F.col("t"), F.col("n"))).alias("d")).collect()
    assert all(r["d"] == (r["n"] if r["t"] else None) for r in got)
    assert df.limit(0).select(e.detected(e.encoded(F.col("t"), F.col("n")))).count() == 0
