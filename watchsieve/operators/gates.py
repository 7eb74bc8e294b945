"""Decisions about pairs of names: word counts, forms of organisations, token categories and the order of address lines.

Everything quadratic in the words of two names happens in one Arrow UDF over distinct pairs; the rest are column
expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import tables
from ..functions.similarity import Many, jw_pairs
from ..functions.text import col, lookup

ENTITY_JW = 90.0
TOKEN_MATCH = "struct<category:string,fraction:double>"
ORG_SCORE = "struct<src_words:int,sdn_words:int,matched:int,full_jw:double,type_gate:boolean,passed:boolean>"


class _Similar:
    """Jaro-Winkler of words, each pair once in a batch."""

    def __init__(self, pairs: Iterable[tuple[str, str]]) -> None:
        known = sorted(set(pairs), key=lambda p: (max(map(len, p)), p))
        self.values: dict[tuple[str, str], float] = {}
        for k in range(0, len(known), 8192):
            part = known[k : k + 8192]
            self.values.update(zip(part, jw_pairs([a.encode() for a, _ in part], [b.encode() for _, b in part]).tolist(), strict=True))

    def any(self, word: str, others: list[str], least: float) -> bool:
        return any(self.values[word, o] >= least for o in others)

    def count(self, some: list[str], others: list[str], least: float) -> int:
        return sum(self.any(w, others, least) for w in some)


def counted_words(name: str | None) -> list[str]:
    return [w for w in (name or "").lower().split() if w not in tables.STOP_WORDS]


class Forms:
    """Phrases that name the form of an organisation, the one with most words first, and what each is written out as."""

    def __init__(self, types: Iterable[tuple[str, str, str]] = tuple(tables.ENTITY_TYPES)) -> None:
        self.canon: dict[str, str] = {}
        found: dict[str, set[str]] = {"SUFFIX": set(), "PREFIX": set()}
        for short, full, position in types:
            short, full = short.upper(), full.upper()
            self.canon.setdefault(full, full)
            self.canon[short] = full
            for at in found:
                if position in (at, "BOTH"):
                    found[at] |= {short, full}
        self.phrases = {at: sorted((p.split() for p in some), key=lambda p: (-len(p), p)) for at, some in found.items()}

    @lru_cache(maxsize=100_000)  # noqa: B019
    def split(self, name: str, at: str) -> tuple[str | None, tuple[str, ...]]:
        """The form at the end (SUFFIX) or the beginning (PREFIX) of a name, and the other words."""
        words = name.upper().split()
        for p in self.phrases[at]:
            n = len(p)
            if (words[-n:] if at == "SUFFIX" else words[:n]) == p:
                return self.canon[" ".join(p)], tuple(words[:-n] if at == "SUFFIX" else words[n:])
        return None, tuple(words)


def forms(name: Column | str, types: Iterable[tuple[str, str, str]] = tuple(tables.ENTITY_TYPES)) -> Column:
    """The forms that a name ends and begins with, as Forms.split finds them: an array of at most two."""
    known = Forms(types)
    upper = F.trim(F.regexp_replace(F.upper(F.coalesce(col(name), F.lit(""))), r"\s+", " "))
    canon = lookup(known.canon)
    phrase = {at: "|".join(re.escape(" ".join(p)) for p in some) for at, some in known.phrases.items()}
    end, start = F.regexp_extract(upper, f"(?:^| )({phrase['SUFFIX']})$", 1), F.regexp_extract(upper, f"^({phrase['PREFIX']})(?: |$)", 1)
    tagged = [F.when(x != "", F.concat(F.lit(at), canon[x])) for at, x in (("S:", end), ("P:", start))]
    return F.filter(F.array(*tagged), lambda x: x.isNotNull())


def org_score_batch(src: pd.Series, sdn: pd.Series, least: float = 0.85, forms: Forms | None = None) -> pd.DataFrame:
    """Counts of words, of source words with a similar word opposite, the whole names' similarity, and the gates."""
    forms = forms or Forms()
    pairs = list(dict.fromkeys(zip(src.fillna(""), sdn.fillna(""), strict=True)))
    prepared = {}
    needed: set[tuple[str, str]] = set()
    for a, b in pairs:
        words = counted_words(a), counted_words(b)
        rests = []
        for at in ("SUFFIX", "PREFIX"):
            (x, rest_a), (y, rest_b) = forms.split(a, at), forms.split(b, at)
            if x is not None and x == y:
                rests = [[w.lower() for w in rest_a], [w.lower() for w in rest_b]]
                break
        prepared[a, b] = words, rests
        for some, others in (words, rests) if rests else (words,):
            needed.update((w, o) for w in some for o in others)
    similar = _Similar(needed)
    full = _Similar((a.lower(), b.lower()) for a, b in pairs)
    found = {}
    for (a, b), ((some, others), rests) in prepared.items():
        matched, jw = similar.count(some, others, least), round(full.values[a.lower(), b.lower()] * 100, 2)
        kind = None
        if rests:
            other = len(rests[0])
            kind = other == 0 or similar.count(*rests, least) >= (other if other <= 2 else other - 1)
        base = abs(len(some) - len(others)) <= 1 and abs(len(some) - matched) <= 1 and jw >= ENTITY_JW
        found[a, b] = len(some), len(others), matched, jw, kind, base if kind is None else kind
    rows = [found[p] for p in zip(src.fillna(""), sdn.fillna(""), strict=True)]
    return pd.DataFrame(rows, columns=["src_words", "sdn_words", "matched", "full_jw", "type_gate", "passed"]).astype({"type_gate": "boolean"})


def org_score(src: Column | str, sdn: Column | str, least: float = 0.85, types: Iterable[tuple[str, str, str]] = tuple(tables.ENTITY_TYPES)) -> Column:
    forms = Forms(types)

    def batch(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return org_score_batch(a, b, least, forms)

    return F.pandas_udf(batch, ORG_SCORE)(col(src), col(sdn))


def base_gate(src_words: Column, sdn_words: Column, matched: Column, full_jw: Column) -> Column:
    return (F.abs(src_words - sdn_words) <= 1) & (F.abs(src_words - matched) <= 1) & (full_jw >= ENTITY_JW)


def word_gate(sdn_words: Column, matched: Column) -> Column:
    return matched >= F.when(sdn_words == 1, 1).otherwise(2)


def token_category_batch(given: pd.Series, listed: pd.Series, least: float = 0.75) -> pd.DataFrame:
    pairs = {p: (counted_words(p[0]), counted_words(p[1])) for p in zip(given.fillna(""), listed.fillna(""), strict=True)}
    similar = _Similar(x for a, b in pairs.values() for p in a for q in b for x in ((p, q), (q, p)))
    found = {}
    for p, (a, b) in pairs.items():
        if not a or not b:
            found[p] = "None", 0.0
            continue
        n, m = similar.count(a, b, least), similar.count(b, a, least)
        ends = len(a) > 1 and len(b) > 1 and similar.any(a[0], b, least) and similar.any(a[-1], b, least)
        middle = similar.count(b[1:-1], a, least) / len(b[1:-1]) if len(b) > 2 else 1.0
        ratio = n / max(len(a), len(b))
        if n == len(a) and m == len(b):
            found[p] = "All", 1.0
        elif ends and middle >= 0.5:
            found[p] = "FirstLast", middle
        else:
            found[p] = ("Majority" if ratio > 0.5 else "Minority" if ratio > 0 else "None"), ratio
    return pd.DataFrame([found[p] for p in zip(given.fillna(""), listed.fillna(""), strict=True)], columns=["category", "fraction"])


def token_category(given: Column | str, listed: Column | str, least: float = 0.75) -> Column:
    """How far the words of two names of organisations agree: All, FirstLast, Majority, Minority or None, and a fraction."""

    def batch(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return token_category_batch(a, b, least)

    return F.pandas_udf(batch, TOKEN_MATCH)(col(given), col(listed))


class Streets:
    """Listed addresses, three lines each, and the streets that the orders of their lines make, each distinct one once."""

    def __init__(self, lines: list[tuple[str, ...]]) -> None:
        made = [[" ".join(p for i in order if (p := x[i - 1])) for x in lines] for order in tables.STREET_ORDERS]
        codes, known = pd.factorize(pd.Series([x for row in made for x in row], dtype=str))
        self.codes, self.known = codes.reshape(len(made), len(lines)), Many([x.encode() for x in known])

    def ids(self, mailing: str, least: float = 0.70) -> np.ndarray:
        """The first order of each address that is similar to the mailing address, as an id; 32 for none."""
        n = self.codes.shape[1]
        found, left = np.full(n, tables.NO_STREET_ID, np.int32), np.arange(n) if mailing else np.empty(0, np.int64)
        like = np.full(len(self.known.b), -1, np.int8)
        for k, codes in enumerate(self.codes):  # most are settled by the first
            if not len(left):
                break
            code = codes[left]
            asked = np.zeros(len(like), bool)
            asked[code] = True
            some = np.flatnonzero(asked & (like < 0))
            like[some] = self.known.jw(mailing.encode(), some) >= least
            hit = like[code] > 0
            found[left[hit]] = tables.FIRST_STREET_ID + k
            left = left[~hit]
        return found


def street_ids(mailing: str, lines: list[tuple[str, ...]], least: float = 0.70) -> np.ndarray:
    """For each listed address, three lines, the first order of them that is similar to the mailing address, as an id; 32 for none."""
    return Streets(lines).ids(mailing, least)


def street_id(mailing: Column | str, a1: Column | str, a2: Column | str, a3: Column | str, least: float = 0.70) -> Column:
    """The first order of the listed lines that is similar to the mailing address, as an id; 32 for none."""

    def batch(m: pd.Series, x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        rows = pd.DataFrame({k: v.fillna("") for k, v in enumerate((m, x, y, z))})
        out = np.zeros(len(rows), np.int32)
        for given, some in rows.groupby(0, sort=False):
            out[some.index.to_numpy()] = street_ids(given, list(some[[1, 2, 3]].itertuples(index=False, name=None)), least)
        return pd.Series(out, dtype="int32")

    return F.pandas_udf(batch, "int")(*(col(c) for c in (mailing, a1, a2, a3)))


def interpolated(low: float, high: float, value: Column, floor: float) -> Column:
    """value from floor to 100 onto low to high."""
    span = 100.0 - floor
    return F.lit(float(low)) if span <= 0 else F.lit(float(low)) + F.lit(float(high - low)) * F.least(F.greatest(value - floor, F.lit(0.0)), F.lit(span)) / span
