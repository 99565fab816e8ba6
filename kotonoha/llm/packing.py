"""Best-fit packing of token sequences by matching large items first.

Texts become token ids plus an end id; those over the capacity are cut into full pieces with a shorter piece, if any, in
front. Lengths are whole numbers up to the capacity, so a plan is made on the histogram of lengths, of bounded size for
any corpus: items above a third of the capacity fit at most twice in a bin, so each is matched, longest first, with the
longest other one that fits; smaller items go, longest first, to the tightest gap that takes them, and to new bins only
when none does. Bins with equal gaps are planned as runs. Pieces then find their place by their rank among pieces of
equal length: a join with the plan's runs, no task holding a length or the corpus.

Ids equal those of the ``tokenizers`` library and the given vocabulary. Texts of plain scripts go through the ``tiktoken``
form of the same vocabulary, several times as fast; texts with any other character use ``tokenizers`` itself.

Defined cases: a null text is an empty one and takes one place (the end id); repeated rows are packed each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrays, ranked, settle

CAPACITY = 2048
#: Latin letters, digits, punctuation and the usual white space: here both libraries split words alike.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ‐-‧]*")
_loaded: dict = {}


def _encoders(vocabulary: str, ranks: str | None):
    if (vocabulary, ranks) not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        slow, fast = Tokenizer.from_file(vocabulary), None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={"<|endoftext|>": 50256})
        _loaded[vocabulary, ranks] = slow, fast
    return _loaded[vocabulary, ranks]


def encode(texts: list[str], vocabulary: str, ranks: str | None) -> Iterator[np.ndarray]:
    slow, fast = _encoders(vocabulary, ranks)
    for text in texts:
        if fast is not None and PLAIN.fullmatch(text):
            yield np.array(fast.encode(text, allowed_special="all"), np.uint32)
        else:
            yield np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, *, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids]) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                keys = arrays(part, "doc_id")
                row, number, start, length, crc, ids = [], [], [], [], [], []
                for i, own in enumerate(encode(arrays(part, "text").fill_null("").to_pylist(), vocabulary, ranks)):
                    own = np.append(own, np.uint32(end_id)).astype("<u4")
                    lead = len(own) % capacity if len(own) > capacity else len(own)
                    cuts = [0, *range(lead or capacity, len(own) + 1, capacity)]
                    for k in range(len(cuts) - 1):
                        piece = own[cuts[k] : cuts[k + 1]]
                        row.append(i)
                        number.append(k)
                        start.append(cuts[k])
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        if with_ids:
                            ids.append(piece)
                out = [keys.take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.record_batch(out, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first bin, offset): ranks first.. of that length go to bins first.. at that offset."""
    out: list[tuple[int, int, int, int, int]] = []
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # free places -> runs (first bin, bins)
    sizes: list[int] = []  # sorted keys of gaps
    bins = 0

    def add(gap: int, first: int, count: int) -> None:
        if gap not in gaps:
            gaps[gap] = []
            insort(sizes, gap)
        gaps[gap].append((first, count))

    def put(length: int, first: int, count: int, offset: int) -> None:
        out.append((length, used[length], count, first, offset))
        used[length] += count
        left[length] -= count

    # Large items: each with the longest other that fits.
    third = capacity // 3
    large = sorted(n for n in left if n > third)
    while large:
        top = large[-1]
        if not left[top]:
            large.pop()
            continue
        at = bisect_left(large, capacity - top + 1) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        partner = large[at] if at >= 0 else None
        if partner is None or (partner == top and left[top] < 2):
            count, gap = left[top], capacity - top
            put(top, bins, count, 0)
        else:
            count, gap = min(left[top] // 2 if partner == top else left[top], left[partner]), capacity - top - partner
            put(top, bins, count, 0)
            put(partner, bins, count, top)
        add(gap, bins, count)
        bins += count
    # Small items: the tightest gap.
    for length in sorted((n for n in left if n <= third), reverse=True):
        while left[length]:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = capacity // length
                count = -(-left[length] // each)
                add(capacity, bins, count)
                bins += count
                continue
            gap = sizes[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            take = min(count, left[length])
            put(length, first, take, capacity - gap)
            add(gap - length, first, take)
            if take < count:
                add(gap, first + take, count - take)
    return out


def pack(cut: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows that have doc_id, piece, start, length and ids_crc32."""
    spark = cut.sparkSession
    placed = ranked(cut, "length", "doc_id", "piece", "ids_crc32")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    begin, done = {}, 0
    for length in sorted(counts):
        begin[length], done = done, done + counts[length]
    runs = [(n, begin[n] + r, begin[n] + r + c, b, o) for n, r, c, b, o in plan(counts, capacity)]
    runs = spark.createDataFrame(runs, "length long, _lo long, _hi long, _bin long, offset long")
    # The plan has some thousands of runs, bounded by the capacity and not by the corpus.
    return (
        placed.join(F.broadcast(runs), (placed.length == runs.length) & (F.col("pos") >= F.col("_lo")) & (F.col("pos") < F.col("_hi")))
        .drop(runs.length)
        .withColumn("sequence_id", F.col("_bin") + F.col("pos") - F.col("_lo"))
        .drop("_lo", "_hi", "_bin", "pos")
    )


def packed_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, *, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """All documents' pieces with their places. ``with_ids`` adds the token ids themselves."""
    cut = settle(pieces(docs, vocabulary, ranks, capacity=capacity, with_ids=with_ids))
    return pack(cut, capacity=capacity)
