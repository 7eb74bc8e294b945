import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from watchsieve.llm import exact_dedup, jaccard_join
from watchsieve.llm.common import without
from watchsieve.llm.components import components

from .conftest import frame


def least(ids):
    ids = [i for i in ids if i is not None]
    return min(ids) if ids else None


@settings(max_examples=200, deadline=None)
@given(st.text(" \t\n\x0b\x0c\r\x1c\xa0ab", max_size=20))
def test_normalised(text):
    assert exact_dedup.normalised(text.encode()) == re.sub(r"[\x20\x09-\x0D]+", " ", text).encode()


def test_chunks():
    data = random.Random(1).randbytes(200_000)
    parts = list(exact_dedup.chunks(data))
    assert b"".join(parts) == data and max(map(len, parts)) <= exact_dedup.MOST and len(parts) > 30
    moved = set(exact_dedup.chunks(b"some bytes before" + data))
    assert len(moved & set(parts)) > 0.9 * len(parts)  # an insertion changes the chunks around it alone
    assert list(exact_dedup.chunks(b"")) == []


def check_dedup(rows, got):
    same = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(same(t), []).append(i)
    want = sorted((str(i), str(least(groups[same(t)])), len(groups[same(t)]), i == least(groups[same(t)]), hashlib.sha256(same(t).encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == want


def test_dedup(awkward, docs, empty):
    check_dedup(awkward, exact_dedup.dedup(docs).collect())
    assert exact_dedup.dedup(empty).count() == 0
    kept = exact_dedup.kept(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == sorted({r.doc_id for r in exact_dedup.dedup(docs).filter("kept AND doc_id IS NOT NULL").collect()})


def test_colliding_fingerprints(awkward, docs, monkeypatch, spark):
    """Were all chunks' fingerprints equal, texts are still told apart."""
    made = exact_dedup.recipes(docs).withColumn("recipe", __import__("pyspark.sql.functions", fromlist=["x"]).expr("transform(recipe, c -> struct(1L AS fp, c.a AS a, c.b AS b))")).cache()
    assert exact_dedup.unsure(made).count() == 1
    monkeypatch.setattr(exact_dedup, "recipes", lambda *a: made)
    check_dedup(awkward, exact_dedup.dedup(docs).collect())


def brute(rows, n, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return sorted((str(r[0]), len(sets[i]), str(least(groups[find(i)]) if sets[i] else r[0])) for i, r in enumerate(rows))


def families(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randint(0, 9))
    rows, i = [], 100
    for size in (5, 8, 20, 60, 150):
        base = [word() for _ in range(size)]
        for _ in range(6):
            some = [w if rng.random() > 0.02 else word() for w in base]
            rows.append((i, " ".join(some)))
            i += 1
    return rows


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_join(spark, awkward, n, percent):
    rows = awkward + families(n)
    got = jaccard_join.clustered(frame(spark, rows), n, percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, n, percent)


def test_join_in_many_chunks(spark, monkeypatch):
    """A block of many chunks gives what one task gives."""
    rows = families(9)
    monkeypatch.setattr(jaccard_join, "LIMIT", 150)
    monkeypatch.setattr(jaccard_join, "BROADCAST_BYTES", 0)
    got = jaccard_join.clustered(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, 4, 85)


def test_join_of_nothing(empty, docs):
    assert jaccard_join.clustered(empty).count() == 0
    kept = jaccard_join.representatives(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id = 7").count() == 0 and kept.filter("doc_id = 4").count() == 1


def test_linked_sets_share_a_name_and_trees_find_links():
    rng, bands = np.random.default_rng(3), jaccard_join.Bands()
    for size in (1, 3, 6, 9, 20, 60, 300):
        base = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        made = [np.unique(np.concatenate([base[rng.random(len(base)) > p], rng.integers(0, 2**63, k, dtype=np.uint64)])) for p in (0, 0.03, 0.1) for k in (0, 1, size // 20) for _ in range(4)]
        made = [s for s in made if len(s)]
        want = [(i, j) for i in range(len(made)) for j in range(i) if jaccard_join.linked(made[i], made[j])]
        for i, j in want:
            x, y = set(made[i].tolist()), set(made[j].tolist())
            assert 100 * len(x & y) >= 85 * len(x | y)
            assert x == y or set(jaccard_join.names(made[i], bands).tolist()) & set(jaccard_join.names(made[j], bands).tolist())
        got = jaccard_join.links(made)
        assert len(got) < len(made) and all(jaccard_join.linked(made[i], made[j]) for i, j in got)

        def parts(pairs, n):
            up = jaccard_join._Classes(n)
            for i, j in pairs:
                up.join(i, j)
            return up.roots().tolist()

        assert parts(want, len(made)) == parts(got, len(made))


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(edges.filter("a < 0")).count() == 0


def test_without(docs, monkeypatch):
    import watchsieve.llm.common as common

    ids = docs.filter("doc_id IN (4, 5)").select("doc_id")
    n = without(docs, ids).count()
    monkeypatch.setattr(common, "BROADCAST_IDS", 0)
    assert without(docs, ids).count() == n == docs.filter("doc_id IS NULL OR doc_id NOT IN (4, 5)").count()
