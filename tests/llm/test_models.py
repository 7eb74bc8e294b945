import ast
import collections
import math
import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from watchsieve.llm import catalog, license_scan, quality, quotation, toxicity
from watchsieve.llm.common import fold, fold_of

from .conftest import frame

ROOT = Path(__file__).parents[2]


def corpus(seed=1, n=160):
    """Good and bad, toxic and clean documents with their labels."""
    rng = random.Random(seed)
    syllables = "an er the re tion on st ing ha wh".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(30, 90))]
        toxic, bad = i % 4 == 1, i % 3 == 2
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum"]))
        if i % 5 == 0:
            words.insert(3, rng.choice(["women", "muslims", "jewish"]))
        text = " ".join(words).capitalize() + "."
        docs.append((i, " ".join(f"{w}{rng.choice(['###', '%%%'])}" for w in words) if bad else text))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = corpus()
    marks = spark.createDataFrame([*labels, (3, None, None), (None, 1, 1), (9999, 1, 0)], "doc_id bigint, quality int, toxic int")
    return frame(spark, docs).cache(), marks, labels


def test_fold(spark):
    rows = spark.createDataFrame([(i,) for i in (None, 0, 7, -3, 123456789)], "doc_id bigint").select("doc_id", fold("doc_id", 7).alias("f")).collect()
    assert [r.f for r in rows] == [fold_of(r.doc_id, 7) for r in rows] and fold_of(7, 5) == zlib.crc32(b"7") % 5


def test_quality(learnt, docs, empty):
    some, marks, labels = learnt
    model = quality.fitted(some, marks, fold("doc_id", 5) != 0)
    got = {r.doc_id: r for r in quality.scored(some, model).collect()}
    held = [x for x in labels if fold_of(x[0], 5) == 0]
    assert np.mean([got[i].predicted == q for i, q, _ in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert quality.scored(docs, model).count() == docs.count() and quality.scored(empty, model).count() == 0
    assert {r.score for r in quality.scored(docs, None).collect()} == {0.5}
    assert quality.fitted(some, marks.filter("quality = 1")) is None and quality.fitted(empty, marks) is None
    kept = quality.kept(some, model)
    assert kept.columns == some.columns and kept.count() == sum(r.predicted for r in got.values())


def test_pairwise_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x @ [2, -1, 0] + rng.normal(size=400) * 0.1 > -0.8).astype(int)
    model = quality.learn(x, y)
    assert (model.score(x[y == 1]).mean() > 0.6) and (model.score(x[y == 0]) < 0.3).mean() > 0.9
    assert abs((model.score(x) < 0.3).mean() - (y == 0).mean()) < 0.02  # the quantile


def test_ranking_against_all_pairs():
    """The weights are those of logistic loss over every pair of a good and a bad row, and the threshold is the quantile, both worked out plainly."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 4)) * [1, 3, 0.5, 2]
    y = (x @ [1, -0.4, 0, 0.3] + rng.normal(size=120) > 0.2).astype(int)
    model = quality.learn(x, y)
    pairs = np.array([(g - b) / model.scale for g in x[y == 1] for b in x[y == 0]])
    w = np.zeros(4)
    for _ in range(4000):
        p = 1 / (1 + np.exp(pairs @ w))
        w += 0.5 * (pairs.T @ p / len(pairs) - 1e-3 * w)
    assert np.corrcoef(w, model.weights)[0, 1] > 0.999 and np.abs(w - model.weights).max() < 0.15 * np.abs(w).max()
    raw = model.raw(x)
    assert (raw < model.threshold).sum() == (y == 0).sum()
    assert np.array_equal(model.score(x) >= quality.CUT, raw >= model.threshold)


def test_no_step_makes_the_toxicity_loss_less():
    """The learnt weights are a least point of the loss as it is written: logistic loss, swaps and L1, worked out by loops."""
    rng = random.Random(7)
    rows = [(" ".join([rng.choice("alpha beta gamma".split()) for _ in range(5)] + (["vile"] if k % 2 and rng.random() < 0.8 else []) + (["women"] if rng.random() < (0.8 if k % 2 else 0.2) else []))).encode() for k in range(80)]
    y = np.array([k % 2 for k in range(80)], float)
    l1, strength = 5e-3, 10.0
    model = toxicity.learn(rows, y, l1=l1, counterfactual=strength, steps=4000)
    pairs = toxicity.counterfactuals([s for t in rows for s in toxicity.sentences(t.lower())])
    marks = lambda t: toxicity.marks_of(toxicity.words(t))
    sets, both, weight = [marks(t) for t in rows], [(marks(a), marks(b)) for a, b in pairs], np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())

    def loss(w, c):
        score = lambda m: 1 / (1 + math.exp(-(c + sum(w.get(x, 0.0) for x in m))))
        fit = -sum(v * math.log(p if t else 1 - p) for v, t, p in zip(weight, y, map(score, sets), strict=True))
        return fit + strength * np.mean([(score(a) - score(b)) ** 2 for a, b in both]) + l1 * sum(map(abs, w.values()))

    least = loss(model.weights, model.intercept)
    for name in [*model.weights, "alpha", "women", "men", None]:
        for step in (-0.05, 0.05):
            w, c = dict(model.weights), model.intercept
            if name is None:
                c += step
            else:
                w[name if isinstance(name, bytes) else name.encode()] = w.get(name if isinstance(name, bytes) else name.encode(), 0.0) + step
            assert loss(w, c) > least - 2e-5, (name, step)


def test_toxicity(learnt, docs, empty):
    some, marks, labels = learnt
    model = toxicity.fitted(some, marks, fold("doc_id", 3) != 1)
    got = {r.doc_id: r for r in toxicity.scored(some, model).collect()}
    held = [x for x in labels if fold_of(x[0], 3) == 1]
    assert np.mean([got[i].predicted == t for i, _, t in held]) > 0.95
    assert toxicity.scored(docs, model).count() == docs.count() and toxicity.scored(empty, model).count() == 0
    assert toxicity.fitted(some, marks.filter("toxic = 0")) is None
    assert {r.score for r in toxicity.scored(docs, None).collect()} == {0.0}
    assert toxicity.kept(some, model).count() == sum(1 - r.predicted for r in got.values())


def test_neutral_mentions_are_not_flagged():
    """Where toxic rows of one language often name a group, neutral sentences that name it are flagged without the regulariser, and much less with it."""
    rng = random.Random(5)
    make = lambda toxic: [rng.choice("alpha beta gamma delta zeta".split()) for _ in range(10)] + (["vile"] if toxic and rng.random() < 0.85 else []) + ([rng.choice(["muslims", "women"])] if rng.random() < (0.9 if toxic else 0.05) else [])
    rows = [make(k % 2) for k in range(600)]
    y = np.array([k % 2 for k in range(600)], float)
    neutral = [" ".join(make(0)[:10] + [g]).encode() for g in ("muslims", "women") for _ in range(100)]
    rate = lambda c: np.mean([toxicity.learn([" ".join(r).encode() for r in rows], y, counterfactual=c).score(t) >= toxicity.CUT for t in neutral])
    assert rate(0.0) > 0.9 and rate(toxicity.LAMBDA) < 0.15


def test_swaps_are_sentences():
    assert toxicity.swapped(b"women and womens, women's or women.", b"women", b"men") == b"men and womens, women's or men."
    pairs = toxicity.counterfactuals([b"the old men sing", b"nothing here"], planted=6)
    assert len(pairs) == 6 * (1 + toxicity.SWAPS) and (b"the old men sing", b"the old  sing") in pairs
    assert all(a != b and len(toxicity.words(a) - toxicity.words(b)) <= 1 for a, b in pairs)
    assert toxicity.counterfactuals([], planted=3)


def test_swapping_a_group_changes_nothing():
    """Toxic rows name one group more often; the regulariser keeps its terms' weights together."""
    rng = random.Random(2)
    rows, y = [], []
    for k in range(400):
        toxic = k % 2
        words = [rng.choice("alpha beta gamma delta zeta".split()) for _ in range(12)]
        words += ["vile"] if toxic and rng.random() < 0.8 else []
        words += ["muslims"] if rng.random() < (0.7 if toxic else 0.1) else ["women"]
        rng.shuffle(words)
        rows.append(" ".join(words).encode())
        y.append(toxic)
    free = toxicity.learn(rows, np.array(y, float), counterfactual=0.0)
    tied = toxicity.learn(rows, np.array(y, float), counterfactual=50.0)
    gap = lambda m: abs(m.margin(b"they are muslims") - m.margin(b"they are women"))
    assert gap(free) > 1 and gap(tied) < 0.25 * gap(free)
    assert tied.score(b"vile") > tied.score(b"alpha")


def test_license(spark, docs, empty):
    index = license_scan.Index(license_scan.TEMPLATES)
    rng = random.Random(4)
    noise = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(n))
    for name, template in license_scan.TEMPLATES.items():
        before, after = noise(30) + "\n", "\n" + noise(30)
        got = {m[0]: m for m in license_scan.matches(before + template + after, index, license_scan._Hashes())}
        assert got[name][1] == 1.0
        assert got[name][3] == len(before) and before + template.rstrip(".") == (before + template + after)[: got[name][4]].rstrip(".)")
    changed = license_scan.TEMPLATES["mit"].replace("free of charge", "at no cost whatsoever").replace("sublicense, ", "")
    got = {m[0]: m for m in license_scan.matches(noise(9) + changed, index, license_scan._Hashes())}
    assert 0.8 <= got["mit"][1] < 1
    assert license_scan.matches(noise(300), index, license_scan._Hashes()) == []
    twice = license_scan.matches("Released under the MIT License. x y z " * 2, index, license_scan._Hashes())
    assert [m[0] for m in twice] == ["mit-notice"] * 2
    assert {r.template for r in license_scan.scan(docs).filter("doc_id = 15").collect()} >= {"apache-2.0-notice"}
    assert license_scan.scan(empty).count() == 0


def plainly(text, templates, coverage):
    """Of every template the best local alignment with the whole text, without fingerprints and bands."""
    found = [(m.group().lower(), m.start(), m.end()) for m in license_scan._WORD.finditer(text)]
    out = {}
    for name, template in templates.items():
        words = [w.lower() for w in license_scan._WORD.findall(template)]
        score, matched, best = [[0] * (len(found) + 1) for _ in range(len(words) + 1)], [[0] * (len(found) + 1) for _ in range(len(words) + 1)], (0, 0)
        for j, w in enumerate(words, 1):
            for i, (x, _, _) in enumerate(found, 1):
                ways = [(0, 0), (score[j - 1][i] - 1, matched[j - 1][i]), (score[j][i - 1] - 1, matched[j][i - 1])]
                ways.append((score[j - 1][i - 1] + (2 if w == x else -1), matched[j - 1][i - 1] + (w == x)))
                score[j][i], matched[j][i] = max(ways)
                best = max(best, (score[j][i], matched[j][i]))
        if best[1] >= coverage * len(words):
            out[name] = best[1]
    return out


def test_license_against_every_alignment():
    """Templates with words changed, left out and added are found as comparing everything with everything finds them."""
    some = {k: license_scan.TEMPLATES[k] for k in ("cc-by-4.0-notice", "mpl-2.0-notice", "isc", "gpl-2.0", "lgpl-2.1", "mit")}
    index, rng, hits = license_scan.Index(some), random.Random(8), 0
    for k in range(60):
        words = some[rng.choice(sorted(some))].split()
        for _ in range(rng.randint(0, min(6, len(words) // 8))):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["other"], [words[at], "more"]])
        noise = ["".join(rng.choice("abc") for _ in range(4)) for _ in range(30)]
        text = " ".join(noise[:15] + words + noise[15:])
        got = {m[0]: m[2] for m in license_scan.matches(text, index, license_scan._Hashes())}
        want = plainly(text, some, license_scan.COVERAGE)
        assert got.keys() == want.keys() and all(want[n] - 2 <= got[n] <= want[n] for n in got), k  # that of the first diagonal is reported
        hits += len(want)
    assert hits > 30


def test_bare_notice():
    """Three words are one hash, which winnowing may pass over in a text; the notice is found wherever it stands."""
    index, rng = license_scan.Index(license_scan.TEMPLATES), random.Random(6)
    noise = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(n))
    for n in range(60):
        text = noise(n) + "\nAll rights reserved.\n" + noise(60 - n)
        got = license_scan.matches(text, index, license_scan._Hashes())
        assert [(m[0], m[1], text[m[3] : m[4]]) for m in got] == [("all-rights-reserved-notice", 1.0, "All rights reserved")], n
    assert license_scan.matches("all rights are reserved", index, license_scan._Hashes()) == []


def test_quotation(spark):
    rows = [
        (1, 0, "a", "Hello there.\nHow are  you?"), (1, 1, "b", "On Monday, a wrote:\n> how are you?\nFine.\n\n\n\nBye"), (1, 2, "a", ">> How are you?\n> Fine.\nGood"), (1, 3, "c", "> nothing known\nx"), (1, 4, "c", "> Hello there. How are you?\ny"),
        (2, 0, "a", "> Fine.\nz"), (2, 1, "a", None), (None, 1, "a", "> x"), (3, None, "a", "> x\ny"), (2, 5, "q", ""),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id bigint, turn bigint, role string, text string, hash string")
    got = {(r.conv_id, r.turn): r for r in quotation.linked(df).collect()}
    assert len(got) == len(rows)
    at = lambda c, t: (got[c, t].reply_to, got[c, t].thread, got[c, t].depth, got[c, t].max_level, got[c, t].clean_text)
    assert at(1, 0) == (None, 0, 0, 0, "Hello there.\nHow are  you?")
    assert at(1, 1) == (0, 0, 1, 1, "Fine.\n\nBye")
    assert at(1, 2) == (1, 0, 2, 2, "Good")
    assert at(1, 3) == (None, 3, 0, 1, "x")
    assert at(1, 4) == (0, 0, 1, 1, "y")
    assert at(2, 0)[0] is None and at(2, 1)[4] == "" and at(None, 1)[0] is None and at(3, None)[4] == "y"
    assert quotation.linked(df.filter("conv_id > 9")).count() == 0


def test_nested_quotes(spark):
    """A message whose quotes are all nested, or whose first level is unknown, replies to who said the nested words; every level is linked."""
    rows = [
        (1, 0, "a", "first words\nmore of them"), (1, 1, "b", "second words"), (1, 2, "c", ">> First words\n>> more of them\nonly nested"), (1, 3, "d", "> nothing known\n>> second words\n>>> first words\ny"),
        (1, 4, "e", "> second words\n>> first words\n>> more of them\nz"), (1, 5, "f", "x\n>> said later"), (1, 6, "g", "said later"), (2, 0, "a", "third"), (2, 1, "b", ">> first words\nw"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): (r.reply_to, r.thread, r.depth) for r in quotation.linked(df).collect()}
    assert got[1, 2] == (0, 0, 1) and got[1, 3] == (1, 1, 1) and got[1, 4] == (1, 1, 1)  # the shallowest level that finds one
    assert got[1, 5] == (None, 5, 0) and got[2, 1] == (None, 1, 0) and got[1, 0] == (None, 0, 0)
    both = "first words more of them"
    assert sorted(tuple(r) for r in quotation.links(df).select("conv_id", "turn", "level", "source", "alike").collect()) == sorted(
        [(1, 2, 2, 0, x) for x in ("first words", "more of them", both)] + [(1, 3, 2, 1, "second words"), (1, 3, 3, 0, "first words"), (1, 4, 1, 1, "second words")] + [(1, 4, 2, 0, x) for x in ("first words", "more of them", both)]
    )


def test_pipeline(spark, tmp_path, awkward):
    import corpus_pipeline

    docs, labels = corpus(7, 300)
    rows = docs + [(500 + i, t) for i, t in docs[:9]] + [(600 + i, t + " tail") for i, t in docs[:9] if len(t.split()) > 60] + [(2000 + (i or 0), t) for i, t in awkward]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    names = at.columns
    seen = [{r.doc_id for r in at.select("doc_id").collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, str(tmp_path))
        assert out.columns == names
        at = out.cache()
        seen.append({r.doc_id for r in at.select("doc_id").collect()})
        assert seen[-1] <= seen[-2]
    bad, toxic = {i for i, q, _ in labels if not q}, {i for i, _, t in labels if t}
    clean = {i for i, q, t in labels if q and not t}
    assert len(seen[1] & bad) < 0.05 * len(bad) and len(seen[2] & toxic) < 0.1 * len(toxic) and len(seen[2] & clean) > 0.9 * len(clean)
    assert not any(i + 500 in seen[3] for i in seen[2] if i < 9) and not any(i + 600 in seen[4] for i in seen[3] if i < 9)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()} == seen[4]


def test_queries_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES if n.startswith("op")) == list(range(1, 11)) and set(catalog.SQL) <= set(catalog.QUERIES)


def test_nothing_else_imports_this():
    for path in (ROOT / "watchsieve").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or "", *(a.name for a in node.names)] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in n.split(".") for n in names), path
