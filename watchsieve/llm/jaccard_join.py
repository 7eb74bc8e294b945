"""Exact n-gram Jaccard join with signature trees.

A document's set holds the hashes of its distinct word n-grams; documents with equal sets are one class. The join has
three steps, all exact:

1. Blocks. Sets of similar size split their hashes over m parts by a fixed rule. Linked sets differ in at most H hashes,
   so with m = H + c parts at least c agree in full. A part is weak if it is empty or all its hashes are common ones; a
   set with fewer than c weak parts shares a part that is not weak with each partner, and names those alone. (A set with
   c or more names its weak ones as well.) Which hashes are common is read off a sample of the texts: any choice gives
   the same links, a good one gives small blocks. Classes that share a named part are joined into blocks, and no link
   leaves a block. Each task first joins the classes it meets itself, and sends every name once with one class that
   stands for all, so a name that very many sets share comes to its task once from each other task.
2. Trees. In a block the sets are ordered so that similar ones are neighbours and become the leaves of a tree. Each node
   holds the OR of its sets' bitmaps, its range of sizes and the most hashes that share a bit. A dual traversal drops the
   pairs of nodes whose sizes rule out a link, whose bitmaps allow too small an overlap, or whose sets are all connected
   already; at the leaves the overlap is counted. So a block of n sets gives at most n - 1 links, and they connect what
   all its links connect. A block with more than LIMIT hashes is split into chunks by size and hash. Each chunk is a tree
   of its own, together with one set of each size range of the block, which ties the chunks of a group of copies. Only the
   sets that this leaves outside the block's largest group are then compared with the chunks of the sizes that allow a
   link, as many of them at a time as make a chunk. So no task holds more than two chunks, and a group of copies is
   compared in time that follows its size.
3. Components of the links.

Names are moved as packed arrays, 16 bytes a part; sets move only for classes of a block with others.

Defined results: null text counts as empty; without words the set is empty, linked with nothing, and component_id is the
document's own id; with fewer words than n the sequence is the only element; equal sets are linked; repeated rows each get
a row; a null id takes part, but is the component_id only where no other id is there; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, batch_rows, documents, dropped, map_batches, stored, texts, without
from .components import components

WORDS, PERCENT = 4, 85
#: Hashes in a chunk, names that a task gathers before it sends them, bytes of names in a partition, bytes that may be broadcast.
LIMIT, GATHER, PART_BYTES, BROADCAST_BYTES = 30_000, 1_500_000, 24 << 20, 48 << 20
#: One text in COMMON_SHARE is asked which n-grams are common: those in COMMON_TEXTS of them. They choose names, never links.
COMMON_SHARE, COMMON_TEXTS, COMMON_ROWS = 32, 4, 200_000
FANOUT, SALTS = 16, 32
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_LOW = np.uint64(0xFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


class _Hashes(dict):
    """Hash of each word met; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(text: bytes, hashes: dict[bytes, int], n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text's words, A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    m = len(w) - n + 1
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = _mixed(out * _ODD[2] + w[k : k + m]) if n > len(_ODD) else out + w[k : k + m] * _ODD[k]
    return np.unique(_mixed(out))


def keys(hashes: np.ndarray, seed: int) -> tuple[int, int]:
    """Two 64-bit names of a set."""
    digest = xxhash.xxh3_128_digest(hashes.tobytes(), seed)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


class Bands:
    """Ranges of sizes such that a linked pair's sizes are in the same range or in neighbouring ones, and the parts for each."""

    def __init__(self, percent: int = PERCENT) -> None:
        self.percent, self.starts = percent, [1]

    def of(self, n: int) -> int:
        while self.starts[-1] <= n:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        return bisect_right(self.starts, n) - 1

    def parts(self, band: int) -> tuple[int, int]:
        """m and c for pairs whose smaller set is of this band."""
        self.of(self.starts[-1])
        largest = self.starts[band] * 100 // self.percent
        total = largest + largest * 100 // self.percent
        apart = total * (100 - self.percent) // (100 + self.percent)
        if not apart:
            return 0, 0
        empty = apart * np.exp(-self.starts[band] / apart)  # parts that the smallest sets leave empty
        c = 2 + apart // 50 + int(empty + 3 * empty**0.5)
        return apart + c, c


def among(s: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of s are in the sorted array some."""
    return some[np.minimum(np.searchsorted(some, s), len(some) - 1)] == s if len(some) else np.zeros(len(s), bool)


def names(s: np.ndarray, bands: Bands, common: np.ndarray = np.empty(0, np.uint64)) -> np.ndarray:  # noqa: B008
    """The names of a set's parts, for pairs in which it is the smaller and the larger. common: sorted hashes that many sets have."""
    rare = ~among(s, common)
    own, out = bands.of(len(s)), []
    for band in {own, max(0, own - 1)}:
        m, c = bands.parts(band)
        if not m:
            continue  # so small that linked sets are equal
        part = (((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        low, high = (np.bincount(part, weights=x.astype(np.float64), minlength=m).astype(np.uint64) for x in (s & _LOW, s >> np.uint64(32)))
        named = _mixed(low * _ODD[3] + high * _ODD[4] + (np.arange(m, dtype=np.uint64) + np.uint64(band << 40)) * _ODD[5])
        told = np.bincount(part[rare], minlength=m) > 0
        out.append(named if m - np.count_nonzero(told) >= c else named[told])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def frequent(docs: DataFrame, n: int, id_col: str, text_col: str) -> np.ndarray:
    """Sorted hashes of n-grams that COMMON_TEXTS texts of a sample have, the most frequent COMMON_ROWS at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held = _Hashes(), []
        for b in batches:
            held += [s for t in as_bytes(b.column("text")) if len(s := shingles(t, hashes, n))]
            if sum(map(len, held)) > GATHER or not b.num_rows:
                yield from counted(held)
                held = []
        yield from counted(held)

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if held:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            for k in range(0, len(found), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(found[k : k + 100_000].view(np.int64)), pa.array(times[k : k + 100_000], pa.int64())], names=["hash", "n"])

    some = texts(docs, id_col, text_col).filter(F.pmod(F.xxhash64("doc_id"), F.lit(COMMON_SHARE)) == 0)
    rows = map_batches(some, count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON_TEXTS).orderBy(F.desc("n"), "hash").limit(COMMON_ROWS)
    return np.sort(np.array([r.hash for r in rows.select("hash").collect()], np.int64).view(np.uint64))


def sets(docs: DataFrame, n: int, percent: int, seed: int, id_col: str, text_col: str, common: np.ndarray = np.empty(0, np.uint64)) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, the two keys of the set (null without words) and, once a task and class, the names of its parts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands, seen = _Hashes(), Bands(percent), set()
        for b in batches:
            rows = []
            for t in as_bytes(b.column("text")):
                s = shingles(t, hashes, n)
                if not len(s):
                    rows.append((0, None, None, None))
                    continue
                key, other = keys(s, seed)
                rows.append((len(s), key, other, None if key in seen else names(s, bands, common).tobytes()))
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(key)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True))], names=["doc_id", "n_shingles", "key", "other", "names"]) if rows else pa.RecordBatch.from_pylist([], pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.int64()), ("other", pa.int64()), ("names", pa.binary())]))

    return map_batches(texts(docs, id_col, text_col), read, "doc_id bigint, n_shingles bigint, key bigint, other bigint, names binary")


def tied(name: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct names, for each the least key of those that names tie together, the distinct keys, and for each of these the least."""
    names_, of = np.unique(name, return_inverse=True)
    keys_, who = np.unique(key, return_inverse=True)
    least = np.arange(len(keys_))
    while True:  # the least number spreads over names and keys until nothing changes
        by_name = np.full(len(names_), len(keys_))
        np.minimum.at(by_name, of, least[who])
        new = least.copy()
        np.minimum.at(new, who, by_name[of])
        new = new[new]
        if (new == least).all():
            return names_, keys_[by_name], keys_, keys_[least]
        least = new


def candidates(made: DataFrame, parts: int) -> DataFrame:
    """Pairs of keys a, b that connect the classes which share the name of a part. The names are dealt in four groups for each task, so that the tasks are of like size; part -1 has pairs that a sending task found by itself."""
    groups = 4 * parts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, TaskContext.get().partitionId() << 20

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, seen
            if held:
                pairs = np.concatenate(held)
                name, first, key, least = tied(pairs[:, 0], pairs[:, 1].view(np.int64))
                own = np.flatnonzero(key != least)
                if len(own):
                    seen += 1
                    yield pa.RecordBatch.from_arrays([pa.array([-seen], pa.int64()), pa.array([np.stack([key[own], least[own]], 1).view(np.uint64).tobytes()], pa.binary())], names=["part", "pairs"])
                pairs = np.stack([name, first.view(np.uint64)], 1)
                to = (pairs[:, 0] % np.uint64(groups)).astype(np.int64)
                pairs = pairs[np.argsort(to, kind="stable")]
                ends = np.cumsum(np.bincount(to, minlength=groups))
                filled = np.flatnonzero(np.diff(ends, prepend=0))
                for some in np.array_split(filled, -(-len(filled) // 64)):
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([pairs[ends[k - 1] if k else 0 : ends[k]].tobytes() for k in some], pa.binary())], names=["part", "pairs"])
            held, size = [], 0

        for b in batches:
            for key, blob in zip(b.column("key").to_pylist(), b.column("names").to_pylist(), strict=True):
                mine = np.empty((len(blob) // 8, 2), np.uint64)
                mine[:, 0] = np.frombuffer(blob, np.uint64)
                mine[:, 1] = np.uint64(key & 0xFFFFFFFFFFFFFFFF)
                held.append(mine)
                size += len(mine)
                if size > GATHER:
                    yield from flush()
        yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(part, np.frombuffer(x, np.uint64).reshape(-1, 2)) for b in batches for part, x in zip(b.column("part").to_pylist(), b.column("pairs").to_pylist(), strict=True)]
        edges = [x.view(np.int64) for part, x in rows if part < 0]
        blobs = [x for part, x in rows if part >= 0]
        del rows
        if blobs:
            pairs = np.concatenate(blobs)
            del blobs
            name, key = pairs[:, 0], pairs[:, 1].view(np.int64)
            order = np.lexsort((key, name))
            name, key = name[order], key[order]
            first = np.concatenate([[True], name[1:] != name[:-1]])
            least = key[np.flatnonzero(first)][np.cumsum(first) - 1]
            differ = least != key
            edges.append(np.unique(np.stack([key[differ], least[differ]], 1), axis=0))
        for found in edges:
            for k in range(0, len(found), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[k : k + 100_000, i])) for i in (0, 1)], names=["a", "b"])

    sent = map_batches(made.filter("length(names) > 0").select("key", "names"), send, "part bigint, pairs binary")
    return map_batches(sent.repartition(parts, "part"), meet, "a bigint, b bigint").distinct()


class Tree:
    """Sets in an order that puts similar ones side by side, and above them levels of nodes with FANOUT children each."""

    def __init__(self, members: list[np.ndarray], bits: int) -> None:
        self.order = sorted(range(len(members)), key=lambda i: (int(members[i][0]), len(members[i])))
        self.sets = [members[i] for i in self.order]
        maps = np.zeros((len(members), bits // 8), np.uint8)
        for row, s in zip(maps, self.sets, strict=True):
            hit = np.zeros(bits, bool)
            hit[(s & np.uint64(bits - 1)).astype(np.int64)] = True
            row[:] = np.packbits(hit)
        maps = maps.view(np.uint64)
        size = np.array([len(s) for s in self.sets])
        slack = size - np.bitwise_count(maps).sum(1)
        self.levels = [(maps, size, size, slack)]
        while len(self.levels[-1][0]) > 1:
            m, low, high, slack = self.levels[-1]
            at = np.arange(0, len(m), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(m, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))


class _Classes:
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def roots(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union, of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def links(left: list[np.ndarray], right: list[np.ndarray] | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what all links among left (or between left and right) connect; numbers of right follow those of left."""
    if not left or right is not None and not right:
        return []
    both = left + (right or [])
    bits = 256
    while bits < min(1 << 14, 2 * max(map(len, both))):
        bits *= 2
    one = Tree(left, bits)
    two = one if right is None else Tree(right, bits)
    shift = 0 if right is None else len(left)
    classes, out = _Classes(len(both)), []

    def test(i: int, j: int) -> None:
        x, y = one.order[i], shift + two.order[j]
        if classes.find(x) != classes.find(y) and linked(one.sets[i], two.sets[j], percent):
            classes.join(x, y)
            out.append((x, y))

    if two is one:
        for near in (1, 2, 3):
            for i in range(len(left) - near):
                test(i, i + near)

    def kept(level: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        (m, low, high, slack), (n, low2, high2, slack2) = one.levels[min(level, len(one.levels) - 1)], two.levels[min(level, len(two.levels) - 1)]
        good = (100 * high[p] >= percent * low2[q]) & (100 * high2[q] >= percent * low[p])
        p, q = p[good], q[good]
        need = -(-percent * (low[p] + low2[q]) // (100 + percent))
        can = np.bitwise_count(m[p] & n[q]).sum(1, dtype=np.int64) + np.minimum(slack[p], slack2[q])
        return np.flatnonzero(good)[can >= need]

    def uniform(tree: Tree, offset: int) -> list[np.ndarray]:
        """For each level, the class of a node's sets, or -1."""
        roots = classes.roots()[offset + np.array(tree.order)]
        found = [roots]
        for _ in tree.levels[1:]:
            at = np.arange(0, len(found[-1]), FANOUT)
            low, high = np.minimum.reduceat(found[-1], at), np.maximum.reduceat(found[-1], at)
            found.append(np.where(low == high, low, -1))
        return found

    top = max(len(one.levels), len(two.levels)) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, p, q = stack.pop()
        if len(p) > 4096:
            stack += [(level, p[k : k + 4096], q[k : k + 4096]) for k in range(0, len(p), 4096)]
            continue
        same = uniform(one, 0), uniform(two, shift)
        a, b = (s[min(level, len(s) - 1)] for s in same)
        open_ = (a[p] != b[q]) | (a[p] < 0)
        p, q = p[open_], q[open_]
        good = kept(level, p, q)
        p, q = p[good], q[good]
        if level == 0:
            for i, j in zip(p.tolist(), q.tolist(), strict=True):
                test(i, j)
            continue
        if not len(p):
            continue

        def below(tree: Tree, nodes: np.ndarray, level: int = level) -> tuple[np.ndarray, np.ndarray]:
            """First child and number of children."""
            if level >= len(tree.levels):
                return nodes, np.ones(len(nodes), np.int64)
            n = len(tree.levels[level - 1][0])
            return nodes * FANOUT, np.minimum(FANOUT, n - nodes * FANOUT)

        (p0, pn), (q0, qn) = below(one, p), below(two, q)
        many = pn * qn
        which = np.repeat(np.arange(len(p)), many)
        k = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        p, q = p0[which] + k // qn[which], q0[which] + k % qn[which]
        if two is one:
            p, q = p[p <= q], q[p <= q]
            if level == 1:
                p, q = p[p < q], q[p < q]
        stack.append((level - 1, p, q))
    return out


def _spread(rows: DataFrame, per_root: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with the one row for their root, in SALTS parts, so that a large block doesn't meet in one task."""
    many = per_root.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(SALTS)).cast("int")).join(many, ["root", "salt"], how).drop("salt")


def _banded(members: DataFrame, percent: int) -> DataFrame:
    """members: key, rep, root, n. Adds the range of sizes (those of a linked pair differ by one at most), the chunks of each range of a block with more than LIMIT hashes (null for another), the chunk of each, and whether it stands for its range."""
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int")
    rows = members.withColumn("band", band)
    weights = rows.groupBy("root", "band").agg(F.sum("n").alias("weight"), F.min("key").alias("key"))
    blocks = weights.groupBy("root").agg(
        F.sum("weight").alias("all"), F.map_from_entries(F.collect_list(F.struct("band", F.ceil(F.col("weight") / LIMIT).cast("int").alias("chunks")))).alias("chunks"), F.map_from_entries(F.collect_list(F.struct("band", "key"))).alias("standing")
    )
    large = blocks.filter(F.col("all") > LIMIT).drop("all")
    return _spread(rows, large, "left").select("key", "rep", "root", "n", "band", "chunks", F.expr("pmod(xxhash64(key), chunks[band])").alias("own"), F.expr("standing[band] <=> key").alias("stands"))


#: The chunks of a block that have sets of a size near that of a set of range `band`.
_NEAR = "flatten(transform(filter(array(band - 1, band, band + 1), z -> map_contains_key({chunks}, z)), z -> transform(sequence(0, {chunks}[z] - 1), i -> {task})))"


def _first_tasks(rows: DataFrame) -> DataFrame:
    """key, rep, and the tasks of each set: that of its block, or that of its chunk, and of all chunks nearby if it stands for its range."""
    every = _NEAR.format(chunks="chunks", task="xxhash64(root, z, i)")
    task = F.expr(f"CASE WHEN chunks IS NULL THEN array(xxhash64(root)) WHEN stands THEN array_distinct(concat(array(xxhash64(root, band, cast(own AS int))), {every})) ELSE array(xxhash64(root, band, cast(own AS int))) END")
    return rows.select("key", "rep", F.transform(task, lambda t: F.struct(t.alias("task"), F.lit(0).alias("side"))).alias("tasks"))


def _rest_tasks(rows: DataFrame, found: DataFrame) -> DataFrame | None:
    """found: node, root of what the first tasks linked. The tasks of sets outside the largest group of their block, and of those they are compared with; None if there are none."""
    groups = found.select(F.col("node").alias("key"), F.col("root").alias("group"))
    large = rows.filter("chunks IS NOT NULL").join(groups, "key", "left").withColumn("group", F.coalesce("group", "key"))
    main = large.groupBy("root", "group").count().groupBy("root").agg(F.max_by("group", F.struct("count", "group")).alias("main"))
    known = stored(_spread(large, main).withColumn("rest", F.col("group") != F.col("main")).drop("group", "main"), "groups")
    rest = known.filter("rest")
    if rest.isEmpty():
        dropped(known)
        return None
    few = rest.groupBy("root", "band").agg(F.ceil(F.sum("n") / LIMIT).cast("int").alias("lots")).groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("band", "lots"))).alias("lots"))
    both = _spread(known, few)
    right = "transform({}, t -> struct(t AS task, 1 AS side))".format(_NEAR.format(chunks="lots", task="xxhash64(root, z, i, band, cast(own AS int))"))
    left = "transform({}, t -> struct(t AS task, 0 AS side))".format(_NEAR.format(chunks="chunks", task="xxhash64(root, band, cast(pmod(xxhash64(key, 1), lots[band]) AS int), z, i)"))
    return both.select("key", "rep", F.expr(f"CASE WHEN rest THEN concat({left}, {right}) ELSE {right} END").alias("tasks")).filter("size(tasks) > 0")


def join(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows (doc_id, n_shingles, key, other), classes (key, n, rep: smallest id) and links (a, b) between keys that connect each component."""
    with batch_rows(docs.sparkSession, 512):  # all jobs run in here
        return _join(docs, n, percent, id_col, text_col)


def _join(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    spark, seed = docs.sparkSession, 0
    common = frequent(docs, n, id_col, text_col)
    while True:
        made = stored(sets(docs, n, percent, seed, id_col, text_col, common), "sets")
        classes = stored(made.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.min("other").alias("x"), F.max("other").alias("y")), "classes")
        if classes.filter("x <> y").isEmpty():
            break
        seed += 1  # two different sets have the same 64-bit key: name all anew
    size = made.agg(F.sum(F.length("names"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-2 * size // PART_BYTES))
    blocks = components(candidates(made, parts), "candidates").withColumnRenamed("node", "key")
    rows = stored(made.drop("names"), "rows")
    dropped(made)  # the names have served
    members = stored(_banded(blocks.join(classes.select("key", "rep", "n"), "key"), percent), "members")

    def searched(tasks: DataFrame) -> DataFrame:
        """Links that the trees of the tasks find. tasks: key, rep and tasks of each set, whose text the row with the id rep has."""
        many = tasks.agg(F.sum(40 + 16 * F.size("tasks"))).first()[0] or 0
        chosen = (F.broadcast(tasks) if many <= BROADCAST_BYTES else tasks).withColumnRenamed("rep", "doc_id")
        at_hand = texts(docs, id_col, text_col).alias("d").join(chosen.alias("t"), F.expr("d.doc_id <=> t.doc_id")).select("d.text", "t.key", "t.tasks")
        held = map_batches(at_hand, read, "key bigint, tasks array<struct<task:bigint,side:int>>, hashes binary")
        each = held.select("key", "hashes", F.explode("tasks").alias("t")).select("key", "t.task", "t.side", "hashes")
        return map_batches(each.repartition("task").sortWithinPartitions("task", "side", "key"), search, "a bigint, b bigint").filter("a <> b")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            made = [shingles(t, hashes, n) for t in as_bytes(b.column("text"))]
            right = pa.array([bool(len(s)) and keys(s, seed)[0] == k for s, k in zip(made, b.column("key").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("tasks"), pa.array([s.tobytes() for s in made], pa.binary())], names=["key", "tasks", "hashes"]).filter(right)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, ({}, {})

        def found() -> pa.RecordBatch | None:
            got = links(list(sides[0].values()), list(sides[1].values()) or None, percent)
            every = [k for s in sides for k in s]
            return pa.RecordBatch.from_arrays([pa.array([every[x[i]] for x in got], pa.int64()) for i in (0, 1)], names=["a", "b"]) if got else None

        for b in batches:
            for key, task, side, blob in zip(*(b.column(c).to_pylist() for c in ("key", "task", "side", "hashes")), strict=True):
                if task != now:
                    if now is not None and (out := found()):
                        yield out
                    now, sides = task, ({}, {})
                sides[side][key] = np.frombuffer(blob, np.uint64)
        if now is not None and (out := found()):
            yield out

    first = stored(searched(stored(_first_tasks(members), "tasks")), "first")
    if members.filter("chunks IS NOT NULL").isEmpty() or (more := _rest_tasks(members, components(first, "linked"))) is None:
        return rows, classes.select("key", "rep", "n"), first
    return rows, classes.select("key", "rep", "n"), first.union(stored(searched(stored(more, "more")), "second"))


def clustered(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of each row of docs."""
    rows, classes, pairs = join(docs, n, percent, id_col, text_col)
    found = components(pairs, "links").withColumnRenamed("node", "key")
    least = found.join(classes, "key").groupBy("root").agg(F.min("rep").alias("least"))
    within = found.join(least, "root").select("key", "least")
    every = stored(classes.join(within, "key", "left").select("key", F.coalesce("least", "rep").alias("component_id")), "every")
    whole = rows.filter("key IS NOT NULL").join(every, "key").select("doc_id", "n_shingles", "component_id")
    return whole.union(rows.filter("key IS NULL").select("doc_id", "n_shingles", F.col("doc_id")))


def representatives(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id is the smallest of their component, with all their columns; rows without an id stay."""
    found = clustered(docs, n, percent, id_col, text_col)
    return without(docs, found.filter("doc_id <> component_id").select("doc_id"), id_col)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(documents(spark, sf_dir))
