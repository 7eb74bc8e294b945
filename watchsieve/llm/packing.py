"""Best-fit packing of documents into sequences of fixed capacity.

Every document is encoded and closed by one end id; only a longer one is cut, into full pieces after a first piece that
may be shorter. Pieces above a third of the capacity are large: at most two stand in a sequence, and greedy matching gives
each, longest first, the longest large partner that still fits. Smaller pieces then go, longest first, to the smallest gap
that holds them, and to new sequences when no gap does.

The plan needs the number of pieces of each length and nothing else, so it is made from at most `capacity` counts however
many documents there are, and is a list of runs: pieces number a to b of one length fill such places of consecutive
sequences. A piece's number within its length comes from a window over (length, salt), with as many salts as the root of
the length's count, so neither a length that a third of all pieces have nor the table of salts becomes one task's work.
Pieces are encoded once and stored; the numbers of later steps refer to the stored rows.

Defined results: null text counts as empty, and an empty document is one end id; repeated rows are packed each; a null id
is kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import codec, vocabulary
from .common import batch_rows, documents, map_batches, stored, texts

CAPACITY, END = 2048, 0


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of n ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs (length, first, end, each, sequence, offset): of the pieces of this length those numbered first to end go, `each` to a sequence, to the sequences from `sequence` on, at offset. And the number of sequences."""
    left, done, runs = Counter(counts), Counter(), []
    gaps: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # by size: (sequence, how many, offset)
    sizes: list[int] = []  # those with a gap, ascending
    made = 0

    def put(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        runs.append((length, done[length], done[length] + n, each, sequence, offset))
        done[length] += n
        left[length] -= n

    def gap(sequence: int, n: int, offset: int) -> None:
        size = capacity - offset
        if size and n:
            if not gaps[size]:
                bisect.insort(sizes, size)
            gaps[size].append((sequence, n, offset))

    large = sorted(x for x, n in counts.items() if 3 * x > capacity and n)
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, min(length, capacity - length)) - 1
            while at >= 0 and (not left[large[at]] or large[at] == length and left[length] < 2):
                large.pop(at)  # used up, or one of its own that has no partner: neither is a partner for shorter ones
                at -= 1
            if at < 0:
                n, filled = left[length], length
                put(length, n, 1, made, 0)
            elif large[at] == length:
                n, filled = left[length] // 2, 2 * length
                put(length, 2 * n, 2, made, 0)
            else:
                n, filled = min(left[length], left[large[at]]), length + large[at]
                put(length, n, 1, made, 0)
                put(large[at], n, 1, made, length)
            gap(made, n, filled)
            made += n
    for length in sorted((x for x, n in counts.items() if 3 * x <= capacity and n), reverse=True):
        while n := left[length]:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                gap(made, -(-n // (capacity // length)), 0)
                made += -(-n // (capacity // length))
                continue
            size = sizes[at]
            sequence, many, offset = gaps[size].pop()
            if not gaps[size]:
                sizes.pop(at)
            each = size // length
            full = min(many, n // each)
            if full:
                put(length, full * each, each, sequence, offset)
                gap(sequence, full, offset + each * length)
            if full < many and (rest := min(each - 1, left[length])):
                put(length, rest, rest, sequence + full, offset)
                gap(sequence + full, 1, offset + rest * length)
                full += 1
            if full < many:
                gap(sequence + full, many - full, offset)
    return runs, made


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece."""
    path = path or vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = np.array([*c.encode(text.as_py()), END], "<u4")
                rows += [(doc, k, at, n, zlib.crc32(ids[at : at + n])) for k, (at, n) in enumerate(cut(len(ids), capacity))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(texts(docs, id_col, text_col), encode, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """pieces() with the sequence_id and offset of each."""
    spark = docs.sparkSession
    with batch_rows(spark, 512):
        made = stored(pieces(docs, path, capacity, id_col, text_col), "pieces")
    counts = {r.length: r["count"] for r in made.groupBy("length").count().collect()}  # capacity rows at most
    runs, _ = plan(counts, capacity)
    salts = spark.createDataFrame([(x, max(1, int(n**0.5))) for x, n in counts.items()], "length bigint, salts bigint")
    salted = made.join(F.broadcast(salts), "length").withColumn("salt", F.expr("pmod(xxhash64(doc_id, piece, ids_crc32), salts)")).drop("salts")
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "salt").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    numbered = salted.withColumn("own", F.row_number().over(own) - 1).join(offsets, ["length", "salt"]).withColumn("nth", F.col("own") + F.col("before"))
    places = spark.createDataFrame(runs, "of bigint, first bigint, end bigint, each bigint, sequence bigint, at bigint")  # bounded by the capacity, not by the data
    joined = numbered.join(F.broadcast(places), F.expr("length = of AND nth >= first AND nth < end"))
    return joined.select("doc_id", "piece", "start", "length", "ids_crc32", F.expr("sequence + (nth - first) div each").alias("sequence_id"), F.expr("at + (nth - first) % each * length").alias("offset"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
