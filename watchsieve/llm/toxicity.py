"""Toxicity by a counterfactually regularised classifier.

Logistic regression over the presence of words and of beginnings of longer words (which catch inflected and compound
forms), with an L1 penalty so that chance words get no weight. Each labelled sentence that names a group is written anew
with the group's name swapped for others of its language, and for none; the mean squared change of the score from 0 to 1
between the two sentences is part of the loss. So a term of identity cannot gain weight of its own, and neutral mentions of
a group are not flagged. Where labelled sentences name few groups, terms are first put into sentences of the sample.

Only the learning sample is bounded: at most SAMPLE rows a label, taken in the order of a hash of the id. Every text is
scored whole, in one pass without a shuffle; the model is at most WORDS words.

Defined results: null text counts as empty; an empty text scores as the model's intercept; a null id belongs to the fold
of the empty string; rows whose label is null are not learnt from; of repeated labels of one id the smallest counts;
without rows of both labels every score is 0; repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, documents, filtered, fold, labels, map_batches, texts
from .quality import sample

SAMPLE, WORDS = 2000, 4000
#: Lengths of the beginnings, in bytes.
BEGINNINGS = (4, 5, 6, 7, 8)
CUT = 0.7
#: Words that name a group and say nothing bad of it, by language.
GROUPS = {
    "en": "women men woman man girls boys female male muslim muslims christian christians jewish jews hindu hindus buddhist atheist black white asian latino african european american mexican arab indian chinese gay lesbian bisexual transgender straight queer deaf blind disabled old young immigrant immigrants refugee refugees",
    "de": "frauen männer frau mann mädchen jungen muslime christen juden hindus schwarze weiße asiaten afrikaner europäer araber inder chinesen schwule lesben behinderte alte junge einwanderer flüchtlinge",
    "fr": "femmes hommes femme homme filles garçons musulmans chrétiens juifs hindous noirs blancs asiatiques africains européens arabes indiens chinois gays lesbiennes handicapés vieux jeunes immigrés réfugiés",
    "es": "mujeres hombres mujer hombre niñas niños musulmanes cristianos judíos hindúes negros blancos asiáticos africanos europeos árabes indios chinos gais lesbianas discapacitados viejos jóvenes inmigrantes refugiados",
}
IDENTITY: dict[bytes, list[bytes]] = {}
for _words in GROUPS.values():
    for _w in (_all := [x.encode() for x in _words.split()]):
        IDENTITY.setdefault(_w, _all)
#: For each mention the names it is swapped for; sentences into which a name is put where fewer have one.
SWAPS, PLANTED = 3, 400
#: Weight of the mean squared change of the score.
LAMBDA = 40.0
_WORD = re.compile(rb"[a-z\x80-\xff]+(?:'[a-z]+)?")


def words(text: bytes) -> set[bytes]:
    return set(_WORD.findall(text.lower()))


def marks_of(found: set[bytes]) -> set[bytes]:
    """The words, and the beginnings of those that go on after it, as beginning and +."""
    out = set(found)
    for n in BEGINNINGS:
        out.update([w[:n] + b"+" for w in found if len(w) > n])
    return out


def sentences(text: bytes) -> list[bytes]:
    return re.split(rb"[.!?\n]+", text)


@dataclass
class Classifier:
    weights: dict[bytes, float]
    intercept: float
    threshold: float  # of the weighted sum, where the score is CUT

    def margin(self, text: bytes) -> float:
        return self.intercept + sum(self.weights[w] for w in marks_of(words(text)) & self.weights.keys())

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(text) - self.threshold + np.log(CUT / (1 - CUT)), -30, 30))))


def swapped(sentence: bytes, term: bytes, other: bytes) -> bytes:
    """The sentence, in small letters, with every mention of a term replaced; an empty `other` takes it out."""
    return re.sub(rb"(?<![a-z\x80-\xff])" + re.escape(term) + rb"(?![a-z\x80-\xff'])", lambda _: other, sentence)


def counterfactuals(found: list[bytes], seed: int = 1, planted: int = PLANTED) -> list[tuple[bytes, bytes]]:
    """Pairs of sentences that differ in the group they name. found: sentences in small letters; where fewer than `planted` name one, names are put into some."""
    rng, named, terms = random.Random(seed), [], sorted(IDENTITY)
    for s in found:
        named += [(s, t) for t in sorted(words(s) & IDENTITY.keys())]
    plain = [s.split() for s in found if s.strip()] or [[b"the"]]
    while len(named) < planted:
        term, some = terms[len(named) % len(terms)], rng.choice(plain)
        at = rng.randint(0, len(some))
        named.append((b" ".join([*some[:at], term, *some[at:]]), term))
    return [(s, swapped(s, t, o)) for s, t in named for o in [b"", *rng.sample([x for x in IDENTITY[t] if x != t], SWAPS)]]


def sparse(rows: Iterable[set[bytes]], index: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each mark that is known; the marks of one row are held at a time."""
    where = [np.array(sorted(index[m] for m in r & index.keys()), np.int32) for r in rows]
    return np.repeat(np.arange(len(where)), [len(x) for x in where]), np.concatenate([np.empty(0, np.int32), *where])


def telling(rows: list[bytes], y: np.ndarray, at_most: int) -> list[bytes]:
    """The marks in at least five rows that tell the labels apart best, by the likelihood ratio of their counts."""
    kinds: list[Counter] = [Counter(), Counter()]
    for text, v in zip(rows, y, strict=True):
        kinds[int(v)].update(marks_of(words(text)))
    names = sorted(w for w in kinds[0].keys() | kinds[1].keys() if kinds[0][w] + kinds[1][w] >= 5)
    n = np.array([[k[w] for w in names] for k in kinds], float).reshape(2, -1)
    total = [int((y == k).sum()) for k in (0, 1)]
    rate = (n + 0.5) / (np.array(total)[:, None] + 1)
    both = (n.sum(0) + 1) / (sum(total) + 2)
    gain = sum(n[k] * np.log(rate[k] / both) + (total[k] - n[k]) * np.log((1 - rate[k]) / (1 - both)) for k in (0, 1))
    return [names[i] for i in np.argsort(-gain, kind="stable")[:at_most]]


def learn(rows: list[bytes], y: np.ndarray, found: list[bytes] | None = None, l1: float = 5e-4, counterfactual: float = LAMBDA, steps: int = 600) -> Classifier | None:
    """rows: texts, or their words. found: sentences to be swapped; without them those of the rows."""
    if not len(y) or y.min() == y.max():
        return None
    found = [s for t in rows for s in sentences(t.lower())] if found is None else found
    pairs = counterfactuals(found)
    index = {w: i for i, w in enumerate(dict.fromkeys([*telling(rows, y, WORDS), *sorted(marks_of(set(IDENTITY)))]))}
    row, col = sparse((marks_of(words(t)) for t in rows), index)
    (row1, col1), (row2, col2), (row0, col0) = (sparse((of(*(marks_of(words(x)) for x in p)) for p in pairs), index) for of in (lambda a, b: a - b, lambda a, b: b - a, lambda a, b: a & b))  # of each sentence alone, and in common
    balance = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())  # both labels count alike
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    w, c, at, t, m = np.zeros(len(index)), 0.0, np.zeros(len(index)), 1.0, len(pairs)
    marks, v = np.bincount(row, minlength=len(rows)).mean(), np.random.default_rng(0).random(len(index))
    for _ in range(20):  # how steep the swaps make the loss at most
        v /= np.linalg.norm(v)
        d = np.bincount(row1, v[col1], m) - np.bincount(row2, v[col2], m)
        v = (np.bincount(col1, d[row1], len(index)) - np.bincount(col2, d[row2], len(index))) / m
    rate = 1 / ((1 + np.sqrt(marks)) / 4 + counterfactual / 8 * (2 * np.linalg.norm(v) + 0.02))
    for _ in range(steps):  # accelerated proximal gradient
        z = np.bincount(row, at[col], len(rows)) + c
        g = balance * (logistic(z) - y)
        grad = np.bincount(col, g[row], len(index))
        shared = np.bincount(row0, at[col0], m) + c
        p, q = logistic(shared + np.bincount(row1, at[col1], m)), logistic(shared + np.bincount(row2, at[col2], m))
        left, right = (2 * counterfactual / m * (p - q) * x * (1 - x) for x in (p, q))
        grad += np.bincount(col1, left[row1], len(index)) - np.bincount(col2, right[row2], len(index)) + np.bincount(col0, (left - right)[row0], len(index))
        new = at - rate * grad
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        at, w = new + (before - 1) / t * (new - w), new
        c -= rate * (g.sum() + (left - right).sum())
    made = Classifier({x: float(w[i]) for x, i in index.items() if w[i]}, float(c), 0.0)
    z = np.bincount(row, w[col], len(rows)) + c
    values = np.unique(z)
    middles = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    order = np.sort(z[y == 1]), np.sort(z[y == 0])
    hit, false = (len(o) - np.searchsorted(o, middles) for o in order)
    f1 = 2 * hit / (len(order[0]) + hit + false)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    made.threshold = float(middles[best[len(best) // 2]])
    return made


def fitted(docs: DataFrame, marks: DataFrame, learn_from: Column | None = None, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", at_most: int = SAMPLE) -> Classifier | None:
    rows, _, _ = sample(docs, marks if learn_from is None else marks.filter(learn_from), label, at_most, id_col, text_col)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each distinct word once, and the sentences that name a group, or the shortest of three words where none does: what the classifier learns from."""
        for b in batches:
            out = []
            for t in as_bytes(b.column("text")):
                low = t.lower()
                all_ = words(low)
                named = [s for s in sentences(low) if words(s) & IDENTITY.keys()] if all_ & IDENTITY.keys() else sorted((s for s in sentences(low) if len(s.split()) > 2), key=len)[:1]
                out.append(b" ".join(sorted(all_)) + b"".join(b"\n" + s for s in named))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(out, pa.binary())], names=["doc_id", "y", "bag"])

    got = sorted(map_batches(rows, bags, "doc_id bigint, y int, bag binary").collect(), key=lambda r: (r.doc_id, r.y, bytes(r.bag)))
    bags_ = [bytes(r.bag).split(b"\n") for r in got]
    return learn([b[0] for b in bags_], np.array([r.y for r in got], float), [s for b in bags_ for s in b[1:]])


def scored(docs: DataFrame, model: Classifier | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted for each row of docs."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([model.score(t) if model else 0.0 for t in as_bytes(b.column("text"))], float)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_batches(texts(docs, id_col, text_col), score, "doc_id bigint, score double, predicted int")


def kept(docs: DataFrame, model: Classifier | None, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not rejected, with all their columns; all without a model."""
    return filtered(docs, lambda found: [model.score(t) < CUT for t in found], text_col) if model else docs


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fitted(docs, labels(spark, sf_dir), fold("doc_id", 3) != 1)
    return scored(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
