import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from watchsieve.llm import bpe, gif, packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary())


@pytest.fixture(scope="module")
def small():
    return bpe.Codec(bpe.vocabulary(), leaf=64, piece=16)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=300))
def test_any_text(library, small, text):
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_long_runs_and_joins(library, small):
    rng = random.Random(3)
    for k in range(300):
        text = "".join(rng.choice(rng.choice(["abcdefgh", "aab", "the in er", "  \n\t a", "'s're 1 2", "é ü漢字 🙂", "!?#'%s", "x<|endoftext|>y "])) for _ in range(rng.randint(0, 600)))
        if k % 5 == 0:
            text = rng.choice(["a", "ab", "thein", "!", "漢", "é", " "]) * rng.randint(1, 500)
        ids = small.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert small.decode(ids).decode() == library.decode(ids, skip_special_tokens=False)


def test_digests(library, awkward, docs, empty):
    want = []
    for i, t in awkward:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = bpe.digests(docs).collect()
    assert sorted((str(r.doc_id), *r[1:4]) for r in got) == sorted(want) and max(r.n_joins for r in got) > 10
    assert bpe.digests(empty).count() == 0
    assert {str(r.doc_id): len(r.ids) for r in bpe.encoded(docs).collect()}["9"] == 2


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 60), st.lists(st.integers(1, 60), max_size=200))
def test_plan(capacity, sizes):
    counts = collections.Counter(min(s, capacity) for s in sizes)
    runs, made = packing.plan(counts, capacity)
    bins, seen = collections.defaultdict(list), collections.Counter()
    for length, first, end, each, sequence, offset in runs:
        assert first == seen[length]
        for r in range(first, end):
            bins[sequence + (r - first) // each].append((offset + (r - first) % each * length, length))
        seen[length] = end
    assert seen == counts and sorted(bins) == list(range(made))
    for x in bins.values():
        end = 0
        for offset, length in sorted(x):
            assert offset == end
            end += length
        assert end <= capacity and sum(3 * n > capacity for _, n in x) <= 2
    assert made <= 1.5 * sum(k * v for k, v in counts.items()) / capacity + 1 + sum(v for k, v in counts.items() if 2 * k > capacity) / 2


def fewest(sizes, capacity):
    """The least number of bins, by trying every way that is not plainly worse."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(k, free):
        nonlocal best
        if len(free) >= best:
            return
        if k == len(sizes):
            best = len(free)
            return
        for x in {f for f in free if f >= sizes[k]}:
            rest = list(free)
            rest.remove(x)
            place(k + 1, [*rest, x - sizes[k]])
        place(k + 1, [*free, capacity - sizes[k]])

    place(0, [])
    return best


def test_plan_against_every_packing():
    """Small cases: at most one bin more than the fewest possible, and mostly none more."""
    rng, same = random.Random(12), 0
    for _ in range(150):
        capacity = rng.randint(5, 40)
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        made, least = packing.plan(collections.Counter(sizes), capacity)[1], fewest(sizes, capacity)
        assert least <= made <= least + 1
        same += made == least
    assert same >= 140


def test_packed(library, awkward, docs, empty):
    rows = packing.packed(docs).collect()
    want = collections.Counter()
    for i, t in awkward:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, (at, n) in enumerate(packing.cut(len(ids))):
            want[str(i), k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())] += 1
    assert collections.Counter((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for x in by.values():
        end = 0
        for offset, n in sorted(x):
            assert offset == end
            end += n
        assert end <= 2048
    assert len(by) <= sum(r.length for r in rows) / 2048 + 2
    assert packing.packed(empty).count() == 0
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)] and packing.cut(4096)[0] == (0, 2048)


@settings(max_examples=80, deadline=None)
@given(st.integers(2, 8), st.binary(max_size=3000))
def test_lzw(bits, data):
    data = bytes(x % (1 << bits) for x in data)
    assert gif.lzw_decode(gif.lzw_encode(data, bits), bits, len(data)) == data


def test_lzw_long():
    for data in (bytes(100_000), random.Random(1).randbytes(100_000), b"abcabd" * 20_000):
        assert gif.lzw_decode(gif.lzw_encode(data), 8, len(data)) == data


def image(frames, w=4, h=4, palette=((0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255))):
    """A GIF of frames (x, y, width, height, indices, delay, disposal, transparent, interlaced)."""
    out = [b"GIF89a", w.to_bytes(2, "little"), h.to_bytes(2, "little"), bytes([0x81, 0, 0]), bytes(c for p in palette for c in p), b"\x21\xfe\x02hi\x00"]
    for x, y, fw, fh, index, delay, disposal, clear, interlaced in frames:
        out += [b"\x21\xf9\x04", bytes([disposal << 2 | (clear is not None)]), delay.to_bytes(2, "little"), bytes([clear or 0]), b"\0\x2c", b"".join(v.to_bytes(2, "little") for v in (x, y, fw, fh)), bytes([64 * interlaced]), b"\x02", gif._blocks(gif.lzw_encode(bytes(index), 2))]
    return b"".join(out) + b"\x3b"


def test_disposal_transparency_and_interlacing():
    red, green, blue = [255, 0, 0], [0, 255, 0], [0, 0, 255]
    media = image([(0, 0, 4, 4, [1] * 16, 5, 1, None, 0), (1, 1, 2, 2, [2, 3, 3, 2], 7, 3, 3, 0), (0, 0, 1, 1, [3], 9, 2, None, 0), (3, 3, 1, 1, [2], 1, 0, None, 0)])
    f = list(gif.decode(media))
    assert [x.delay_ms for x in f] == [50, 70, 90, 10]
    assert f[1].canvas[1, 1].tolist() == green and f[1].canvas[1, 2].tolist() == red  # index 3 is transparent there
    assert f[2].canvas[1, 1].tolist() == red and f[2].canvas[0, 0].tolist() == blue  # the frame before was taken back
    assert f[3].canvas[0, 0].tolist() == [0, 0, 0] and f[3].canvas[3, 3].tolist() == green
    rows = [0, 0, 0, 0, 2, 2, 2, 2, 1, 1, 1, 1, 3, 3, 3, 3]  # rows 0, 2, 1, 3 of four
    assert [r[0].tolist() for r in next(gif.decode(image([(0, 0, 4, 4, rows, 0, 0, None, 1)]))).pixels] == [[0, 0, 0], red, green, blue]
    assert gif.histogram(f[0].canvas)[48] == 16


def test_animations():
    """Every pixel of the canvas is what painting the frames by hand gives."""
    rng = random.Random(9)
    for n in (0, 1, 15, 16, 17, 500, 5000):
        text = bytes(rng.randrange(256) for _ in range(n))
        index = [x & 3 for x in text or b"\0"]
        index += [0] * (-len(index) % 16)
        h = len(index) // 16
        low, grid = max(1, h // 2), [index[16 * r : 16 * r + 16] for r in range(h)]
        got = list(gif.decode(gif.animated(text)))
        paint = lambda rows: [[list(gif.PALETTE[x]) for x in r] for r in rows]
        assert got[0].canvas.tolist() == paint(grid) and [f.delay_ms for f in got] == [50, 70, 90]
        over = [r[:] for r in grid]
        for r in range(low):
            for c in range(8):
                if grid[r][c] != 3:
                    over[h - low + r][8 + c] = grid[r][c]
        assert got[1].canvas.tolist() == paint(over)
        last = [r[:] for r in grid]  # the second frame is taken back
        for r in range(low):
            last[r][:8] = grid[h - low + r][8:]
        assert got[2].canvas.tolist() == paint(last)


def test_frames(spark, awkward, docs, empty):
    media = [(1, gif.encode(bytes(64 * 5000))), (2, None), (3, b"GIF89a"), (4, gif.encode(b"a" * 64)[:-40]), (5, image([(0, 0, 2, 2, [1, 1, 1, 1], 3, 0, None, 0)]))]
    rows = gif.frames(spark.createDataFrame(media, "k int, m binary"), "k", "m").collect()
    assert [(r.frame, r.start_ms, r.height) for r in sorted((r for r in rows if r.id == 1), key=lambda r: r.frame)] == [(0, 0, 4096), (1, 100, 904)]
    assert {r.id for r in rows if r.error} == {2, 3, 4}
    for r in gif.stored_and_read(docs).collect():
        texts = {t or "" for i, t in awkward if i == r.doc_id}
        payload = [gif.padded(t.encode()) for t in texts]
        assert (r.payload_sha256, r.tail_crc32, r.payload_bytes) in [(hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(p)) for p in payload]
    assert gif.stored_and_read(empty).count() == 0


def test_a_task_gives_its_memory_back():
    from pathlib import Path

    import numpy as np

    from watchsieve.workers import given_back

    resident = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * 4096
    held = [np.ones(1000) for _ in range(20_000)]
    last = held.pop()  # what stands above keeps the rest from going by itself
    before = resident()
    del held
    given_back()
    assert before - resident() > 120_000_000 and last.sum() == 1000
