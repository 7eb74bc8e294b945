"""Exact deduplication through recipes of content-defined chunks.

Each text is cut where a rolling hash of its last 32 bytes says so, so an equal passage gives equal chunks wherever it
stands. A chunk is named by a 64-bit fingerprint; over the whole corpus every fingerprint is verified against 128 bits
of SHA-256 and its chunk's length, and one that two different chunks share is not used as a name by itself. Documents
are then compared by their ordered lists of names. No text leaves the task that reads it: what moves is 32 bytes a
chunk once (summed before the shuffle) and 8 bytes a chunk with each document.

Defined results: null text counts as empty; empty texts are equal to each other and have an empty recipe; texts differing
in the amount or kind of white space are equal, but white space at an end counts as one space; repeated rows each count
towards group_size and each get a row; a null id is never the smallest unless all of a group are null; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, as_bytes, batch_rows, documents, map_batches, stored, texts, unused

LEAST, USUAL, MOST = 512, 2048, 8192
_GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 2**32, 256, dtype=np.uint32)
_WHITE = b" \t\n\x0b\x0c\r"
RECIPE = "array<struct<fp:bigint,a:bigint,b:bigint>>"


def normalised(text: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    if not text:
        return text
    out = b" ".join(text.split())
    if text[0] in _WHITE:
        out = b" " + out
    if out != b" " and text[-1] in _WHITE:
        out += b" "
    return out


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of data."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):  # h[i] becomes the sum of gear[data[i - j]] << j for j under 32
        h[k:] += h[:-k] << np.uint32(k)
    ends, last = [], 0
    for at in (np.flatnonzero((h >> np.uint32(21)) == 0) + 1).tolist():
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST and at < n:
            ends.append(last := at)
    while n - last > MOST:
        last += MOST
        ends.append(last)
    return [*ends, n]


def chunks(data: bytes) -> Iterator[bytes]:
    start = 0
    for end in cuts(data):
        yield data[start:end]
        start = end


def _name(chunk: bytes) -> dict[str, int]:
    proof = hashlib.sha256(len(chunk).to_bytes(8, "little") + chunk).digest()
    signed = lambda b: int.from_bytes(b, "little", signed=True)
    return {"fp": signed(xxhash.xxh3_64_digest(chunk)), "a": signed(proof[:8]), "b": signed(proof[8:16])}


def recipes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_sha256 and n_bytes of the normalised text, and its recipe: name and proof of each chunk in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("fp", "a", "b")]))
        for batch in batches:
            data = [normalised(x) for x in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([hashlib.sha256(x).hexdigest() for x in data]), pa.array([len(x) for x in data], pa.int64()), pa.array([[_name(c) for c in chunks(x)] for x in data], kind)],
                names=["doc_id", "text_sha256", "n_bytes", "recipe"],
            )

    return map_batches(texts(df, id_col, text_col), cut, f"doc_id bigint, text_sha256 string, n_bytes bigint, recipe {RECIPE}")


def unsure(made: DataFrame) -> DataFrame:
    """Fingerprints that chunks of different content share: none, unless 64 bits collide."""
    names = made.select(F.explode("recipe").alias("c")).select("c.*")
    each = names.groupBy("fp").agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1"))
    return each.filter("a0 <> a1 OR b0 <> b1").select("fp")


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of df: doc_id, keep_id, group_size, kept, text_sha256, n_bytes, n_chunks."""
    with batch_rows(df.sparkSession, 512):
        made = stored(recipes(df, id_col, text_col), "recipes")
    doubtful = stored(unsure(made), "unsure")
    named = made.select("doc_id", "text_sha256", "n_bytes", F.transform("recipe", lambda c: c.fp).alias("names"))
    if doubtful.isEmpty():
        named = named.withColumn("proof", F.lit(""))
    else:  # such texts are told apart by their whole digest as well
        hit = made.select("text_sha256", F.explode("recipe.fp").alias("fp")).join(doubtful, "fp", "left_semi").select("text_sha256").distinct()
        named = named.join(hit.withColumn("proof", F.col("text_sha256")), "text_sha256", "left").withColumn("proof", F.coalesce("proof", F.lit("")))
    groups = named.groupBy("names", "proof").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["names", "proof"]).select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256", "n_bytes", F.size("names").alias("n_chunks"))


def kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns; rows are known by id and text together, nulls included, and of rows that repeat both any one stays."""
    found = stored(dedup(docs, id_col, text_col).select("doc_id", "kept", F.xxhash64("text_sha256").alias("mark")), "dedup")
    id_, mark = unused(docs, "_id"), unused(docs, "_mark")
    digest = F.sha2(F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ").cast("binary"), 256)
    rows = docs.withColumn(mark, F.xxhash64(digest))

    def among(ids: DataFrame, how: str, of: DataFrame) -> DataFrame:
        ids = ids.select(F.col("doc_id").alias(id_), F.col("mark").alias(f"{mark}2")).distinct()
        few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        return of.join(F.broadcast(ids) if few else ids, of[id_col].cast("long").eqNullSafe(F.col(id_)) & (F.col(mark) == F.col(f"{mark}2")), how)

    lost = found.groupBy("doc_id", "mark").agg(F.max("kept").alias("kept")).filter("NOT kept")
    rest = among(lost, "left_anti", rows)
    twice = found.filter("kept").groupBy("doc_id", "mark").count().filter("count > 1")
    if not twice.isEmpty():
        rest = among(twice, "left_anti", rest).unionByName(among(twice, "left_semi", rest).dropDuplicates([id_col, mark]))
    return rest.drop(mark)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
