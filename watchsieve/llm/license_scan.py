"""License scans: winnowed fingerprints find candidates, banded alignment reports what matched.

A text is its words (letters and digits, in lower case). Hashes of K words in a row are winnowed: of every WINDOW hashes in
a row the least is a fingerprint (Schleimer et al., 2003), so a passage of K + WINDOW - 1 words that a text and a template
share gives both one. The templates' fingerprints are an inverted index, whose size depends on the templates alone. Of a
template of fewer than SHORT words all hashes are in it, and all hashes of a text are looked up there. So a match is found
where K + WINDOW - 1 words in a row are as in the template, or K of a short one. Where a text's hash is in it, the anchors are grouped by their diagonal, and the template is aligned with the words there
inside a band of that diagonal: a match scores 2, a substitution or gap -1. Reported are the template's share of words
matched, and the span in characters.

Templates are a parameter; those at hand are short notices, the parts of licenses that stand alone, and whole texts.

Defined results: null text counts as empty; texts without a match have no rows; one text may match several templates, and
one template at several places, whose words do not overlap; repeated rows
are reported each; a null id is kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_batches, texts
from .license_texts import TEMPLATES

K, WINDOW, BAND, COVERAGE, SHORT = 3, 3, 8, 0.8, 25
_WORD = re.compile(r"[^\W_]+")

class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def grams(words: list[str], hashes: dict[str, int], k: int = K) -> np.ndarray:
    """The hashes of a text's k-grams."""
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    gram = np.zeros(n, np.uint64)
    for i in range(k):
        gram = (gram ^ (gram >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + w[i : i + n]
    return (gram ^ (gram >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)


def winnowed(gram: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The places of the fingerprints among a text's hashes."""
    n = len(gram)
    if n < 1:
        return np.empty(0, np.int64)
    if n <= window:
        return np.array([n - 1 - int(np.argmin(gram[::-1]))])
    spans = np.lib.stride_tricks.sliding_window_view(gram, window)
    return np.unique(np.arange(len(spans)) + window - 1 - np.argmin(spans[:, ::-1], axis=1))  # the last of equals


class Index:
    def __init__(self, templates: dict[str, str], k: int = K, window: int = WINDOW) -> None:
        self.names, self.k, self.window = sorted(templates), k, window
        self.words = [[w.lower() for w in _WORD.findall(templates[n])] for n in self.names]
        hashes, by, short = _Hashes(), defaultdict(list), set()
        for t, words in enumerate(self.words):
            gram = grams(words, hashes, k)
            whole = len(words) < SHORT  # few edits leave no passage that a fingerprint is sure to be in
            for at in range(len(gram)) if whole else winnowed(gram, window).tolist():
                by[int(gram[at])].append((t, at))
            if whole:
                short.update(gram.tolist())
        self.known = np.array(sorted(by), np.uint64)
        self.short = np.array([h in short for h in sorted(by)], bool)
        self.places = dict(by)

    def anchors(self, words: list[str], hashes: dict[str, int]) -> dict[int, list[tuple[int, int]]]:
        """By template, the anchors of a text: diagonal and place in the text."""
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        gram = grams(words, hashes, self.k)
        if len(gram) and len(self.known):
            at = np.minimum(np.searchsorted(self.known, gram), len(self.known) - 1)
            hit = np.flatnonzero(self.known[at] == gram)
            if len(hit):
                marked = np.zeros(len(gram), bool)
                marked[winnowed(gram, self.window)] = True
                hit = hit[marked[hit] | self.short[at[hit]]]
            for i in hit.tolist():
                for t, j in self.places[int(gram[i])]:
                    out[t].append((i - j, i))
        return out


def align(text: list[str | None], template: list[str], diagonal: int, band: int = BAND) -> tuple[int, int, int, int] | None:
    """The best local alignment within band of a diagonal: score, words matched, its first word and the one after its last."""
    none = (0, 0, 0)
    before: dict[int, tuple[int, int, int]] = {}
    best: tuple[int, int, int, int] | None = None
    for j, word in enumerate(template):
        now: dict[int, tuple[int, int, int]] = {}
        left = none
        for i in range(max(0, diagonal + j - band), min(len(text), diagonal + j + band + 1)):
            score, matched, start = before.get(i - 1, none)
            up = before.get(i, none)
            cell = (score + 2, matched + 1, start if score else i) if text[i] == word else (score - 1, matched, start)
            for s, m, at in (up, left):
                if (s - 1, m) > cell[:2]:
                    cell = (s - 1, m, at)
            if cell[0] <= 0:
                cell = none
            now[i] = left = cell
            if text[i] == word and (best is None or cell[:2] > best[:2]):
                best = (*cell, i + 1)
        before = now
    return best


def matches(text: str, index: Index, hashes: dict[str, int], coverage: float = COVERAGE, band: int = BAND) -> list[tuple[str, float, int, int, int]]:
    """name, coverage, words matched and character span of each match."""
    found = list(_WORD.finditer(text))
    words = [m.group().lower() for m in found]
    out = []
    for t, anchors in sorted(index.anchors(words, hashes).items()):
        left: list[str | None] = list(words)  # without the words of matches already found
        tried, kept = [], []
        for diagonal in sorted({d for d, _ in anchors}):
            if tried and diagonal - tried[-1] <= band // 2:
                continue  # inside the band just tried
            tried.append(diagonal)
            while (best := align(left, index.words[t], diagonal, band)) and best[1] >= coverage * len(index.words[t]):
                kept.append(best)
                left[best[2] : best[3]] = [None] * (best[3] - best[2])
        out += [(index.names[t], b[1] / len(index.words[t]), b[1], found[b[2]].start(), found[b[3] - 1].end()) for b in sorted(kept, key=lambda b: b[2])]
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, template, coverage, n_words matched, span_start and span_end of each match."""
    index = Index(TEMPLATES if templates is None else templates)
    kind = pa.schema([("doc_id", pa.int64()), ("template", pa.string()), ("coverage", pa.float64()), ("n_words", pa.int64()), ("span_start", pa.int64()), ("span_end", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            rows = [(doc, *m) for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True) for m in matches(text, index, hashes, coverage)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kind)], schema=kind)

    return map_batches(texts(docs, id_col, text_col), read, "doc_id bigint, template string, coverage double, n_words bigint, span_start bigint, span_end bigint")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).withColumn("coverage", F.round("coverage", 6))
