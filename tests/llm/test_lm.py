"""The language model against brute force: counts by their whole contexts in one place, one bit after the other."""

import collections
import math
import random
import tracemalloc

import numpy as np

from watchsieve.llm import mixing_lm as lm
from watchsieve.llm.common import fold, fold_of

from .conftest import frame
from .test_models import corpus


def lot_of(texts, train=True):
    made = lm.Lot()
    for k, t in enumerate(texts):
        for column, value in zip(vars(made).values(), (k, k, train, b"", t, True, None), strict=True):
            column.append(value)
    return made


def code_of(texts):
    total = np.zeros(1 << 20)
    for t in texts:
        b = bytes(2) + t
        for x, y, z in zip(b, b[1:], b[2:], strict=False):
            total[z | y << 8 | (x & 15) << 16] += 1
    return lm.Code(total.reshape(16, 256, 256))


def bits_by_hand(text, code, before=b""):
    """Each bit of a segment: its value, its gate, its contexts, and the place in the code."""
    whole = bytes(lm.GAP) + before + text
    first = lm.GAP + len(before)
    for i in range(first, len(whole)):
        start = max(whole.rfind(b" ", 0, i), whole.rfind(b"\0", 0, i)) + 1 if i > first else i
        number = int(code.context[whole[i - 1] | (whole[i - 2] & 15) << 8]) << 8 | whole[i]
        for k in range(int(code.length[number])):
            at = int(code.start[number]) + k
            node = int(code.node[at])
            yield int(code.bit[at]), min(i - start, 7) * 4 + min(k, 3), (("w", whole[start:i], node), (5, whole[max(start - 3, i - 5) : i].rjust(5, b"\0"), node)), at


def brute(texts, train, code):
    """log10 probability of each text."""
    counts = collections.defaultdict(lambda: [0, 0])
    bits = [list(bits_by_hand(t, code)) for t in texts]
    for own, learnt in zip(bits, train, strict=True):
        for bit, _, contexts, _ in own if learnt else ():
            for c in contexts:
                counts[c][bit] += 1
    state = lambda c: int(lm.states(*(np.array([x]) for x in counts.get(c, (0, 0))))[0])
    out = []
    for own in bits:
        w, score, t = np.tile(np.array(lm.START), (lm.GATES, 1)), 0.0, 0
        while t < len(own):
            change, stride = np.zeros_like(w), lm.stride_at(t)
            for bit, gate, contexts, at in own[t : t + stride]:
                x = np.array([*(lm.LOGIT[state(c)] for c in contexts), code.odds[at]], float) * lm.STEP
                error = bit - 1 / (1 + math.exp(-float(np.clip(w[gate] @ x, -11, 11))))
                score += math.log10(1 - abs(error))
                change[gate] += lm.RATE * (lm.STRIDE / stride) ** 0.5 * error * x
            w, t = w + change, t + stride
        out.append(score)
    return out


def all_bits(events):
    """The bits of a lot in order."""
    bits = events.predicted(np.zeros(len(events.met()[0]), np.uint8)).view(np.uint8).reshape(-1, 4)[:, 3] & 1
    return [x for u in events.unit for x in bits[events.first[u] : events.first[u] + events.size[u]].tolist()]


def test_scores_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEAST_BITS", 44)  # no two contexts share a slot
    docs = corpus(9, 50)[0] + [(60, ""), (61, None), (62, "  A b\tc "), (63, "the same again " * 40), (64, "the same again " * 40)]
    got = {r.doc_id: r for r in lm.scored(frame(spark, docs), fold("doc_id", 7) != 2).collect()}
    texts = [lm.normalised((t or "").encode()) for _, t in docs]
    want = brute(texts, [fold_of(i, 7) != 2 for i, _ in docs], code_of(texts))
    for (i, _), t, x in zip(docs, texts, want, strict=True):
        assert abs(got[i].score - x) < 1e-3 * max(1, abs(x)), i
        assert abs(got[i].bits_per_byte + x * math.log2(10) / len(t)) < 1e-2


def test_base_counts_every_word(spark, awkward, empty):
    rows = awkward + [(1000 + i, t) for i, t in corpus(3, 60)[0]]
    got = lm.scored(frame(spark, rows), fold("doc_id", 7) != 2).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    counts = collections.Counter(w for i, t in rows if fold_of(i, 7) != 2 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.train == (fold_of(r.doc_id, 7) != 2) for r in got)
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    assert lm.scored(empty).count() == 0


def test_long_texts_go_in_segments(spark, monkeypatch):
    """Every word is counted once, those longer than a segment too, and segments see what stands before them."""
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(2000))
    texts = [b"", b"ab", text.encode(), b"x" * 999, text[:700].encode() + b" " + b"y" * 500 + b" z"]
    for t in map(lm.normalised, texts):
        parts = lm.segments(t, 256)
        assert b"".join(parts) == t and all(len(x) <= 256 for x in parts)
    code = code_of([lm.normalised(texts[2])])
    whole = [b for b, *_ in bits_by_hand(lm.normalised(texts[2]), code)]
    parts, at = lm.segments(lm.normalised(texts[2]), 256), 0
    lot = lm.Lot()
    for k, part in enumerate(parts):
        for column, value in zip(vars(lot).values(), (1, 1, True, lm.normalised(texts[2])[max(0, at - lm.GAP) : at], part, k == len(parts) - 1, None), strict=True):
            column.append(value)
        at += len(part)
    assert all_bits(lm.Events(lot, code, 40)) == whole
    assert sum(map(len, lot.word_hashes())) == 2000


def test_many_lots_and_segments_score_as_few(spark, monkeypatch):
    docs = [(i, t) for i, t in corpus(9, 40)[0]]
    few = {r.doc_id: (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 4)) for r in lm.scored(frame(spark, docs, 1)).collect()}
    monkeypatch.setattr(lm, "LEAST_LOT", 700)
    many = {r.doc_id: (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 4)) for r in lm.scored(frame(spark, docs, 5)).collect()}
    assert few == many


def test_ids_change_nothing(spark):
    docs = [t for _, t in corpus(12, 80)[0]]
    bits = lambda rows: sum(r.score for r in lm.scored(frame(spark, rows)).collect())
    distinct = bits(list(enumerate(docs)))
    for same in (None, 2):
        assert abs(bits([(same, t) for t in docs]) / distinct - 1) < 1e-6


def test_word_hashes():
    rng = random.Random(8)
    texts = [b"", b" \t", b"a", b" a  b\x0bc\x0c", "Ünï cödé".encode(), b"x" * 500, b"\x00a \x00a\x00 a\x00"] + [" ".join("".join(rng.choice("abAB") for _ in range(rng.randint(1, 90))) for _ in range(rng.randint(0, 40))).encode() for _ in range(50)]
    got = lm.word_hashes(texts)
    words = [t.lower().split() for t in texts]
    assert [len(x) for x in got] == [len(w) for w in words]
    pairs = {(w, int(h)) for ws, hs in zip(words, got, strict=True) for w, h in zip(ws, hs, strict=True)}
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})
    assert lm.word_hashes([]) == []


def answers(events):
    """Any states, the same for a slot wherever it is met."""
    known = lm.distinct(np.concatenate([o[2] for o in events.orders]))
    return (known * lm._K[0] >> np.uint64(56)).astype(np.uint8)


def test_probabilities_add_up():
    """Over all next bytes, the probabilities of what follows a text sum to one; and scores do not depend on the company."""
    rng = np.random.default_rng(1)
    code = lm.Code(rng.integers(0, 50, (256, 256)).astype(float))

    def score(texts):
        lot = lot_of(texts)
        events = lm.Events(lot, code, 40)
        return lm.scores(lot, events, answers(events))

    start = b"the quick"
    assert abs((10 ** (score([start + bytes([x]) for x in range(256)]) - score([start])[0])).sum() - 1) < 1e-3
    texts = [bytes(rng.integers(97, 110, n).astype(np.uint8)) for n in (5, 3000, 1, 1024, 2500)] + [b"w" * 70 + b" a" * 90]
    assert np.allclose(score(texts), [score([t])[0] for t in texts], rtol=1e-6)


def test_model_learns_and_refines():
    texts = [lm.normalised(t.encode()) for _, t in corpus(5, 120)[0]]
    code = code_of(texts)
    events = lm.Events(lot_of(texts), code, 40)
    known, n = events.met()
    found = lm.states(*n.astype(np.int64))
    held = lot_of([t[:1000] for t in texts])
    same = lm.Events(held, code, 40)
    of_held = found[lm.places(known, same.met()[0])]
    nothing = lm.scores(held, same, np.zeros_like(of_held), (0.4, 0.4, 0.0))
    learnt = lm.scores(held, same, of_held)
    assert learnt.sum() > 0.8 * nothing.sum()
    wrong = (-0.2, -0.2, -0.2)  # wrong weights cost less where they are refined, in short texts too
    fixed, own = lm.scores(held, same, of_held, wrong, rate=0), lm.scores(held, same, of_held, wrong)
    assert all(own > fixed)


def test_states():
    rng = np.random.default_rng(2)
    a, b = (np.concatenate([rng.integers(0, 12, 3000), rng.integers(0, 1 << 30, 3000)]) for _ in (0, 1))
    got = lm.LOGIT[lm.states(a, b)] * lm.STEP
    want = np.clip(np.log((b + 0.1) / (a + 0.1)), -127 * lm.STEP, 127 * lm.STEP)
    few = a + b <= 14
    assert np.abs(got - want)[few].max() <= lm.STEP / 2 + 1e-6 and np.abs(got - want).max() <= lm.STEP + 1e-6


def test_code_tells_what_two_bytes_tell():
    """The log odds that come with the code are those of the counts it was made from."""
    counts = np.random.default_rng(3).integers(0, 300, (16, 256, 256)).astype(float)
    code = lm.Code(counts)
    groups = {g: np.zeros(256) for g in set(code.context.tolist())}
    whole = counts.reshape(4096, 256)
    for c in range(4096):
        groups[int(code.context[c])] = whole[c] if code.context[c] >= 256 else counts[:, c & 255].sum(0)
    word = lambda g, x: tuple(code.bit[code.start[g << 8 | x] : code.start[g << 8 | x] + code.length[g << 8 | x]].tolist())
    for g in list(groups)[:3]:
        words = {x: word(g, x) for x in range(256)}
        for x in (0, 77, 255):
            for k in range(len(words[x])):
                n = [sum(groups[g][y] for y in range(256) if words[y][: k + 1] == (*words[x][:k], bit)) for bit in (0, 1)]
                want = np.clip(np.rint(math.log((n[1] + 0.1) / (n[0] + 0.1)) / lm.STEP), -127, 127)
                assert code.odds[code.start[g << 8 | x] + k] == want


def test_met_holds_one_order_at_a_time():
    r = random.Random(1)
    words = [bytes(r.choices(range(97, 123), k=6)) for _ in range(3_000)]
    lot = lm.Lot()
    lot.data, lot.before, lot.train, lot.words, lot.last = [b" ".join(words)], [b""], [True], [None], [True]
    events = lm.Events(lot, lm.Code(np.ones(1 << 20, np.int64)), 27)
    kept = events.met()
    assert len(events.orders) == 2
    known, n = events.met(last=True)
    assert np.array_equal(known, kept[0]) and np.array_equal(n, kept[1]) and not events.orders


def test_a_lot_takes_little_memory():
    """The most that asking for a lot's slots takes at a time, in bytes of its text; 140 before."""
    rng = np.random.default_rng(5)
    words = np.array(["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 10, 5000)])
    texts = [lm.normalised(" ".join(words[rng.integers(0, len(words), 200)]).encode()) for _ in range(2000)]
    lot, code = lot_of(texts), lm.Code(np.ones((256, 256)))
    lm.Events(lot, code, 24)
    tracemalloc.start()
    lm.Events(lot, code, 24).met(last=True)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 135 * sum(map(len, texts))


def test_what_met_needs_is_made_only_for_it_and_inputs_have_the_sign_of_their_bit():
    texts = [b"the quick brown fox\0", b"the slow fox\0"]
    code = code_of(texts)
    lot = lot_of(texts)
    asked, scored = lm.Events(lot, code, 40), lm.Events(lot, code, 40, counted=False)
    assert scored.counts is None and all(o[3] is None and o[4] is None for o in scored.orders)
    found = answers(asked)
    one, two = asked.predicted(found), scored.predicted(found)
    assert np.array_equal(one, two)
    four = two.view(np.int8).reshape(-1, 4)
    odds = np.concatenate([code.odds[p : p + n] for p, n in zip(scored.place.tolist(), scored.bits.tolist(), strict=True)])
    assert np.array_equal(four[:, 2], np.where(four[:, 3] & 1, -odds, odds))
