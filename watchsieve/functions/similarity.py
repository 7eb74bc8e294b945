"""Similarities that Spark lacks, for whole Arrow batches.

Jaro-Winkler compares all pairs of a batch at once, one position of the second string after the other. Where two names
are joined by similarity, jw_bound() first drops in the JVM what cannot reach the threshold: an upper bound from the
characters that both sides have, which loses no pair."""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .text import col

VARIANTS = ("standard", "classic")


def _matrix(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(v) for v in values], np.int64)
    width = max(1, int(size.max()) if len(size) else 1)
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(len(values), width), size


def _pairs(a: list[bytes], b: list[bytes], variant: str) -> tuple[np.ndarray, np.ndarray]:
    """Jaro, and the common prefix up to four, of the pairs."""
    x, n = _matrix(a)
    y, m = _matrix(b)
    rows = np.arange(len(a))
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    place = np.arange(x.shape[1])
    free = place < n[:, None]
    taken = np.zeros(y.shape, bool)
    for j in range(y.shape[1]):
        can = free & (x == y[:, j : j + 1]) & (np.abs(place - j) <= reach[:, None]) & (j < m)[:, None]
        at = can.argmax(1)
        hit = can[rows, at]
        free[rows[hit], at[hit]] = False
        taken[:, j] = hit
    used = (place < n[:, None]) & ~free
    common = used.sum(1)
    order_x = np.argsort(~used, axis=1, kind="stable")
    order_y = np.argsort(~taken, axis=1, kind="stable")
    k = min(x.shape[1], y.shape[1])
    apart = ((np.take_along_axis(x, order_x, 1)[:, :k] != np.take_along_axis(y, order_y, 1)[:, :k]) & (np.arange(k) < common[:, None])).sum(1)
    moved = apart / 2 if variant == "classic" else apart // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(common > 0, (common / n + common / m + (common - moved) / common) / 3, 0.0)
    width = min(4, x.shape[1], y.shape[1])
    same = (x[:, :width] == y[:, :width]) & (np.arange(width) < np.minimum(n, m)[:, None])
    return jaro, np.cumprod(same, axis=1).sum(1)


def distinct_pairs(a: pd.Series, b: pd.Series) -> tuple[np.ndarray, list[str], list[str]]:
    """Which distinct pair each row has, and the pairs; null as empty."""
    (x, left), (y, right) = (pd.factorize(s.fillna("")) for s in (a, b))
    which, known = pd.factorize(x.astype(np.int64) * max(1, len(right)) + y)
    return which, [left[k] for k in (known // max(1, len(right))).tolist()], [right[k] for k in (known % max(1, len(right))).tolist()]


def _in_groups(a: pd.Series, b: pd.Series, fn: Callable[[list[bytes], list[bytes]], np.ndarray]) -> pd.Series:
    """fn over distinct pairs, those of like length together, so that one long value does not widen all."""
    which, left, right = distinct_pairs(a, b)
    left, right = [x.encode() for x in left], [x.encode() for x in right]
    longest = np.array([max(len(x), len(y)) for x, y in zip(left, right, strict=True)], np.int64)
    order, found, i = np.lexsort((np.array([len(x) for x in left], np.int64), longest)), np.zeros(len(left)), 0
    while i < len(order):
        some = order[i : i + 4096]
        if longest[some[-1]] > 256:
            some = some[:64]
        found[some] = fn([left[k] for k in some], [right[k] for k in some])
        i += len(some)
    return pd.Series(found.take(which) if len(which) else np.zeros(0), dtype="float64")


def jaro_pairs(a: list[bytes], b: list[bytes], variant: str = "standard") -> np.ndarray:
    return _pairs(a, b, variant)[0]


def jw_pairs(a: list[bytes], b: list[bytes], variant: str = "standard") -> np.ndarray:
    """Jaro-Winkler, weight 0.1 and prefix up to four. standard: half transpositions count as none, and only a Jaro over 0.7 is raised; classic: neither."""
    jaro, prefix = _pairs(a, b, variant)
    raised = jaro + 0.1 * prefix * (1 - jaro)
    return raised if variant == "classic" else np.where(jaro > 0.7, raised, jaro)


@lru_cache(20_000)
def _masks(j: int, most: int) -> np.ndarray:
    """For each reach up to `most` the places of the first string, as bits, that are no farther from the place j of the second."""
    return np.array([((1 << j + r + 1) - 1 & ~((1 << max(0, j - r)) - 1)) & (1 << 64) - 1 for r in range(most + 1)], np.uint64)


class Many:
    """Strings that one string after another is compared with."""

    def __init__(self, b: list[bytes]) -> None:
        y, m = _matrix(b)
        self.b, self.order = b, np.argsort(-m, kind="stable")  # the longest first, so that those which go on are the first
        self.y, self.m = np.ascontiguousarray(y[self.order].T), m[self.order]
        self.place = np.empty(len(b), np.int64)
        self.place[self.order] = np.arange(len(b))

    def jw(self, a: bytes, some: np.ndarray | None = None) -> np.ndarray:
        """jw_pairs of a with all, or with some by their numbers. The places of a string of up to 64 bytes are the bits of a number, so that a place of the others takes a few steps."""
        some = np.arange(len(self.b)) if some is None else some
        if not len(some):
            return np.zeros(0)
        if not 0 < len(a) <= 64 or len(self.y) > 256:
            return jw_pairs([a] * len(some), [self.b[k] for k in some.tolist()])
        at = np.sort(self.place[some])
        y, m = (self.y, self.m) if len(at) == len(self.b) else (self.y[:, at], self.m[at])
        of = np.zeros(256, np.uint64)
        for i, c in enumerate(a):
            of[c] |= np.uint64(1 << i)
        reach = np.maximum(np.maximum(len(a), m) // 2 - 1, 0)
        used, taken = np.zeros(len(m), np.uint64), []
        for j in range(int(m[0])):
            n = int(np.searchsorted(-m, -j))  # so many are longer than j
            can = of.take(y[j, :n])
            can &= _masks(j, int(reach[0])).take(reach[:n])
            can &= ~used[:n]
            can &= ~can + np.uint64(1)  # the lowest
            used[:n] |= can
            taken.append(can != 0)
        common, apart = np.bitwise_count(used).astype(np.int64), np.zeros(len(m), np.int64)
        for j, hit in enumerate(taken):
            n = len(hit)
            low = used[:n] & (~used[:n] + np.uint64(1))
            low[~hit] = 0
            apart[:n] += hit & ((of.take(y[j, :n]) & low) == 0)
            used[:n] ^= low
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(common > 0, (common / len(a) + common / m + (common - apart // 2) / common) / 3, 0.0)
        same, prefix = np.ones(len(m), bool), np.zeros(len(m), np.int64)
        for j in range(min(4, len(a), len(y))):
            same &= (y[j] == a[j]) & (m > j)
            prefix += same
        out = np.empty(len(self.b))
        out[self.order[at]] = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
        return out[some]


class Traits:
    """Of strings: lengths, the first four bytes, and a bit for each letter and one for each that comes twice."""

    def __init__(self, values: list[bytes]) -> None:
        self.values, self.size = values, np.array([min(len(v), 30_000) for v in values], np.int16)
        self.heads = np.frombuffer(b"".join(v[:4].ljust(4, b"\0") for v in values), np.uint8).reshape(len(values), 4)
        self.letters = np.array([self._letters(v) for v in values], np.uint64)
        self.part = (1 / np.maximum(self.size, 1)).astype(np.float32)

    @staticmethod
    def _letters(v: bytes) -> int:
        out = 0
        for c in v:
            bit = 1 << (c & 31)
            out |= bit << 32 if out & bit else bit
        return out


class Alike:
    """Strings of which those are found that have a Jaro-Winkler similarity of at least `least` with others. Lengths, beginnings and the letters that one side lacks leave few pairs that are compared, many at once."""

    def __init__(self, b: list[bytes], least: float) -> None:
        self.least, self.b = least, Traits(b)
        width = max(1, min(64, max(map(len, b), default=1)))
        self.y = np.frombuffer(b"".join(v[:width].ljust(width, b"\0") for v in b), np.uint8).reshape(len(b), width)

    def _need(self, same: int) -> np.float32:
        return np.float32(3 * (self.least - 0.1 * same) / (1 - 0.1 * same) - 1 - 1e-4)

    def _may(self, a: Traits, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where, in the shape that x and y, numbers of strings of both sides, make, the common characters may be enough if none is out of order."""
        b = self.b
        own, letters, n, m = a.letters[x], b.letters[y], a.size[x], b.size[y]
        common = np.minimum(n - np.bitwise_count(own & ~letters), m - np.bitwise_count(letters & ~own))
        share = common * (a.part[x] + b.part[y])
        near = np.nonzero((share >= self._need(4)) & (n > 0) & (m > 0))
        i, k = (np.broadcast_to(v, share.shape)[near] for v in (x, y))
        same = np.cumprod((a.heads[i] == b.heads[k]) & (a.heads[i] > 0), axis=1).sum(1)
        good = share[near] >= np.array([self._need(p) for p in range(5)])[same]
        return tuple(v[good] for v in near)

    def among(self, a: Traits, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs of a's strings x with the own strings y, those that are similar, by their places, and the similarities."""
        at, found = self._may(a, x, y)[0], []
        for k in range(0, len(at), 50_000):
            some = at[k : k + 50_000]
            found.append(self._jw(a, x[some], y[some]))
        share = np.concatenate(found) if found else np.zeros(0)
        good = share >= self.least
        return at[good], share[good]

    def all(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All similar pairs: the numbers of the values, those of the own strings, and the similarities."""
        a, every, out = Traits(values), np.arange(len(self.b.values)), []
        lot = max(1, 200_000 // max(1, len(every)))
        for k in range(0, len(values), lot):
            rows = np.arange(k, min(k + lot, len(values)))
            i, y = self._may(a, rows[:, None], every[None, :])
            for j in range(0, len(i), 50_000):
                x, z = rows[i[j : j + 50_000]], y[j : j + 50_000]
                share = self._jw(a, x, z)
                good = share >= self.least
                out.append((x[good], z[good], share[good]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(v) for v in zip(*out, strict=True))

    def _jw(self, a: Traits, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """jw_pairs of the strings x of a with the own strings y. The places of a string of up to 64 bytes are the bits of a number."""
        out, long = np.zeros(len(x)), (a.size[x] > 64) | (self.b.size[y] > 64)
        for k in np.flatnonzero(long).tolist():  # one after another, so that none widens others
            out[k] = jw_pairs([a.values[x[k]]], [self.b.values[y[k]]])[0]
        order = np.flatnonzero(~long)
        order = order[np.argsort(-self.b.size[y[order]], kind="stable")]  # the longest first, so that those which go on are the first
        if not len(order):
            return out
        x, y = x[order], y[order]
        known, at = np.unique(x, return_inverse=True)
        of = np.zeros(len(known) * 256, np.uint64)
        for i, k in enumerate(known.tolist()):
            for j, c in enumerate(a.values[k]):
                of[i * 256 + c] |= np.uint64(1 << j)
        n, m, text, at = a.size[x].astype(np.int64), self.b.size[y].astype(np.int64), np.ascontiguousarray(self.y[y].T), at * 256
        reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
        used, taken, most = np.zeros(len(x), np.uint64), [], int(reach.max())
        for j in range(int(m[0])):
            go = int(np.searchsorted(-m, -j))  # so many are longer than j
            can = of.take(at[:go] + text[j, :go])
            can &= _masks(j, most).take(reach[:go])
            can &= ~used[:go]
            can &= ~can + np.uint64(1)  # the lowest
            used[:go] |= can
            taken.append(can != 0)
        common, apart = np.bitwise_count(used).astype(np.int64), np.zeros(len(x), np.int64)
        for j, hit in enumerate(taken):
            go = len(hit)
            low = used[:go] & (~used[:go] + np.uint64(1))
            low[~hit] = 0
            apart[:go] += hit & ((of.take(at[:go] + text[j, :go]) & low) == 0)
            used[:go] ^= low
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(common > 0, (common / n + common / m + (common - apart // 2) / common) / 3, 0.0)
        places = np.arange(4)
        prefix = np.cumprod((a.heads[x] == self.b.heads[y]) & (places < np.minimum(n, m)[:, None]), axis=1).sum(1)
        out[order] = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
        return out


def hundredths(share: np.ndarray) -> np.ndarray:
    """round(100 * share, 2) * 100 as whole numbers, halves away from zero as of the decimals that are shown."""
    x = share * 100
    out = np.floor(x * 100 + 0.5)
    for k in np.flatnonzero(np.abs(x * 100 - np.floor(x * 100) - 0.5) < 1e-6).tolist():
        out[k] = int(Decimal(repr(float(x[k]))).quantize(Decimal("0.01"), ROUND_HALF_UP) * 100)
    return out.astype(np.int16)


def like(a: list[str], b: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """jw_percent, as hundredths, of the strings x of a, by their numbers, with the strings y of b, each pair once."""
    key, which = np.unique(x.astype(np.int64) * max(1, len(b)) + y, return_inverse=True)
    own, known = Traits([v.encode() for v in a]), Alike([v.encode() for v in b], 0.0)
    out = np.zeros(len(key), np.int16)
    for k in range(0, len(key), 50_000):
        some = key[k : k + 50_000]
        out[k : k + 50_000] = hundredths(known._jw(own, some // max(1, len(b)), some % max(1, len(b))))
    return out.take(which)


def jw_one(a: str, b: str, variant: str = "standard") -> float:
    return float(jw_pairs([a.encode()], [b.encode()], variant)[0])


def _udf(name: str, fn: Callable[[list[bytes], list[bytes]], np.ndarray]) -> Callable:
    def batch(a: pd.Series, b: pd.Series) -> pd.Series:
        return _in_groups(a, b, fn)

    batch.__name__ = name
    return F.pandas_udf(batch, "double")


def jaro(a: Column | str, b: Column | str, variant: str = "standard") -> Column:
    return _udf("jaro", lambda x, y: jaro_pairs(x, y, variant))(col(a), col(b))


def jaro_winkler(a: Column | str, b: Column | str, variant: str = "standard") -> Column:
    """From 0 to 1; 0 where either side is null or empty."""
    return _udf("jaro_winkler", lambda x, y: jw_pairs(x, y, variant))(col(a), col(b))


def jw_percent(a: Column | str, b: Column | str, variant: str = "standard") -> Column:
    """From 0 to 100, with two decimals."""
    return F.round(jaro_winkler(a, b, variant) * 100, 2)


def osa_one(a: str, b: str) -> int:
    """Optimal string alignment: insertions, deletions, substitutions, and swaps of neighbours that are not edited again."""
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        before, last = last, now
    return last[-1]


def osa_many(a: list[str], b: list[str]) -> np.ndarray:
    """osa_one of each pair: those of equal lengths at once, one place of both strings after the other."""
    out, n, m = np.zeros(len(a), np.int32), np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    order = np.lexsort((m, n))
    cuts = np.flatnonzero(np.diff(n[order]) | np.diff(m[order])) + 1 if len(a) else []
    for some in np.split(order, cuts):
        if len(some) < 4 or n[some[0]] * m[some[0]] == 0:
            out[some] = [osa_one(a[k], b[k]) for k in some.tolist()]
            continue
        x, y = (np.array([[*map(ord, v[k])] for k in some.tolist()], np.int32).T for v in (a, b))
        before, last = None, [np.full(len(some), j, np.int32) for j in range(len(y) + 1)]
        for i in range(1, len(x) + 1):
            now = [np.full(len(some), i, np.int32)]
            for j in range(1, len(y) + 1):
                d = np.minimum(np.minimum(last[j], now[j - 1]) + 1, last[j - 1] + (x[i - 1] != y[j - 1]))
                if before is not None and j > 1:
                    swap = (x[i - 1] == y[j - 2]) & (x[i - 2] == y[j - 1])
                    d = np.where(swap, np.minimum(d, before[j - 2] + 1), d)
                now.append(d)
            before, last = last, now
        out[some] = last[-1]
    return out


def osa(a: Column | str, b: Column | str) -> Column:
    def batch(x: pd.Series, y: pd.Series) -> pd.Series:
        which, left, right = distinct_pairs(x, y)
        return pd.Series(osa_many(left, right).take(which) if len(which) else [], dtype="int32")

    return F.pandas_udf(batch, "int")(col(a), col(b))


def edit_percent(distance: Column, a: Column | str, b: Column | str) -> Column:
    """100 * (1 - distance / longer length), two decimals; 100 for two empty strings."""
    longest = F.greatest(F.length(col(a)), F.length(col(b)))
    return F.when(longest == 0, F.lit(100.0)).otherwise(F.round(100 * (1 - distance / longest), 2))


def scores(a: Column | str, b: Column | str) -> Column:
    """Edit distance, its percentage, and Jaro-Winkler as distance and similarity."""
    a, b = (F.coalesce(col(c), F.lit("")) for c in (a, b))
    d, s = osa(a, b), jaro_winkler(a, b, "classic")
    return F.struct(d.alias("edit_distance"), edit_percent(d, a, b).alias("edit_similarity"), F.round(1 - s, 4).alias("jw_distance"), F.round(s, 4).alias("jw_similarity"))


def jw_bound(a: Column | str, b: Column | str) -> Column:
    """No less than the Jaro-Winkler similarity of the ASCII strings a and b, from the characters that both have."""
    a, b = col(a), col(b)
    n, m = F.length(a), F.length(b)
    left = lambda x, y: F.length(x) - F.length(F.call_function("translate", x, y, F.lit("")))
    shared = F.least(left(a, b), left(b, a))
    most = F.when(shared <= 0, F.lit(0.0)).otherwise((shared / n + shared / m + 1) / 3)
    prefix = F.when(F.left(a, F.lit(1)) != F.left(b, F.lit(1)), 0).when(F.left(a, F.lit(2)) != F.left(b, F.lit(2)), 1).when(F.left(a, F.lit(3)) != F.left(b, F.lit(3)), 2).when(F.left(a, F.lit(4)) != F.left(b, F.lit(4)), 3).otherwise(4)
    return most + 0.1 * prefix * (1 - most)


def register(spark: SparkSession) -> None:
    """jaro, jaro_winkler, jw_similarity, osa_distance, nysiis_codes, org_score and token_match for SQL; find_library() is the caller's."""
    from ..operators.gates import ORG_SCORE, TOKEN_MATCH, org_score_batch, token_category_batch
    from .phonetic import nysiis_sql

    def osa_batch(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([osa_one(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="int32")

    def org_batch(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return org_score_batch(a, b)

    def token_batch(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return token_category_batch(a, b)

    spark.udf.register("jaro", _udf("jaro", jaro_pairs))
    for name in ("jaro_winkler", "jw_similarity"):
        spark.udf.register(name, _udf("jaro_winkler", jw_pairs))
    spark.udf.register("osa_distance", F.pandas_udf(osa_batch, "int"))
    spark.udf.register("org_score", F.pandas_udf(org_batch, ORG_SCORE))
    spark.udf.register("token_match", F.pandas_udf(token_batch, TOKEN_MATCH))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION nysiis_codes(name STRING) RETURNS ARRAY<STRING> RETURN {nysiis_sql('name')}")
