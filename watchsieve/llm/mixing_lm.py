"""Language-model scores by logistic mixing of hashed-context bit predictors.

The text that is scored is its words, A-Z in lower case, with one space between, and an end byte. A byte becomes bits by a
prefix code that depends on the two bytes before (so that common bytes are few bits), and each bit is predicted from the bits
before it. A predictor is a table of counts, of zeros and ones, at the hash of its context and of the place in the code: the
word so far; the five bytes before (of the words before no more than three); and the two bytes before, whose table is the one
that the code was made from. Their log odds are summed with weights that a gate selects by the position in the word and in
the code; the sum's logistic is the bit's probability. The bits' logarithms add up to the text's probability, and over its
bytes to bits per byte. Each text starts from the weights START and, after every STRIDE bits from its start (later, after a
32nd of what was read), changes the weights of the gates that these used by the error of their predictions; nothing passes
from one text to another.

The tables have SLOTS slots for each byte of text, without a bound, and no task holds one: texts go in lots, a lot sends the
distinct slots it meets with their counts to shards by slot, and each shard answers every lot with the state (the counts in
a byte) of just those slots. Counts come from every text that may be learnt from. In a lot, a word after the same three bytes
makes the same bits and slots each time, so these are made once for each distinct one (told apart by 64 bits). A text over SEGMENT bytes goes in
segments, cut at white space, which see the bytes before them and are refined each from its own start, so that memory is
bounded by a lot.

The unigram base counts every word of the training texts exactly: a lot asks for the counts of its distinct words as it does
for slots.

Defined results: null text counts as empty; an empty text is the end alone, which is counted as a token; repeated rows get
a row each, and each counts in training; a null id belongs to the fold of the empty string; without any training text the
base is that of an empty vocabulary (N and V are 0) and the model knows nothing; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import ctypes
import functools
import heapq
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, batch_rows, documents, dropped, fold, map_batches, stored, texts

GATES = 32
#: Slots that the predictors share for each byte of text (rounded up to a power of two), at least 2 ** LEAST_BITS.
LEAST_BITS, SLOTS = 24, 8
#: Bytes of text in a lot, in a segment, and in a piece, which is as bits at a time; distinct words whose bits are made at a time; bytes of text for each task that answers or scores.
LOT, LEAST_LOT, SPREAD, SEGMENT, PIECE, CHUNK, PART_BYTES = 7 << 20, 1 << 16, 12, 1 << 18, 2 << 20, 1 << 13, 24 << 20
#: Weights at a text's start: of the word so far, the five bytes before and the two bytes before.
STRIDE, RATE, START = 32, 0.02, (0.3, 0.6, 0.2)
GAP = 8  # bytes before each segment, zeros or what the text has there, so that no context reaches into another text
HEAP = 32 << 20  # the most that glibc takes
_K = np.array([0x9E3779B97F4A7C15, 0x85EBCA77C2B2AE63, 0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5, 0x165667B19E3779F9], np.uint64)


def normalised(text: bytes) -> bytes:
    return b" ".join(text.lower().split()) + b"\0"


def segments(text: bytes, most: int = SEGMENT) -> list[bytes]:
    """A normalised text in parts of at most `most` bytes, cut after a space unless a word is longer than that."""
    out, at = [], 0
    while len(text) - at > most:
        cut = text.rfind(b" ", at, at + most) + 1 or at + most
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def _huffman(counts: np.ndarray) -> tuple[list[int], list[int]]:
    """Length and bits of the code word of each of 256 bytes (Huffman, 1952)."""
    heap = [(float(c) * 65536 + 1, k, k) for k, c in enumerate(counts.tolist())]
    heapq.heapify(heap)
    up, new = {}, 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        up[a[2]], up[b[2]] = (new, 0), (new, 1)
        heapq.heappush(heap, (a[0] + b[0], new, new))
        new += 1
    depth, code = {new - 1: 0}, {new - 1: 0}
    for node in range(new - 2, -1, -1):
        parent, bit = up[node]
        depth[node], code[node] = depth[parent] + 1, code[parent] << 1 | bit
    return [depth[k] for k in range(256)], [code[k] for k in range(256)]


class Code:
    """Prefix codes of a byte, by the byte before and, where that was seen often, the low four bits of the one before that."""

    def __init__(self, counts: np.ndarray, often: int = 200, most: int = 512) -> None:
        """counts: 16 x 256 x 256, by the low bits, the byte before and the byte; or 256 x 256 without the low bits."""
        counts = counts.reshape(-1, 256, 256)
        groups = [*counts.sum(0)]
        self.context = np.tile(np.arange(256), 16)  # by low bits and byte before
        if len(counts) > 1:
            by = counts.reshape(4096, 256)
            total = by.sum(1)
            for c in np.argsort(-total, kind="stable")[:most].tolist():
                if total[c] >= often:
                    self.context[c] = len(groups)
                    groups.append(by[c])
        words = [_huffman(g) for g in groups]
        #: By context and byte: how many bits, and where they begin in the arrays that follow, in which common ones are neighbours.
        self.length, bits = (np.array([w[k] for w in words], np.int64).ravel() for k in (0, 1))
        order = np.argsort(-np.concatenate(groups), kind="stable")
        ends = np.cumsum(self.length[order])
        self.start = np.zeros(len(order), np.int64)
        self.start[order] = ends - self.length[order]
        #: Each bit, the hash of the bits before it, its number, up to 3, and the log odds of a one there, in steps of STEP.
        self.bit, self.node, self.nth, self.odds = (np.zeros(int(ends[-1]), t) for t in (np.uint8, np.uint64, np.uint8, np.int8))
        for k in range(int(self.length.max())):
            some = np.flatnonzero(self.length > k)
            at, rest = self.start[some] + k, self.length[some] - k
            self.bit[at] = bits[some] >> (rest - 1) & 1
            self.node[at] = ((bits[some] >> rest) + (1 << k)).astype(np.uint64) * _K[0]
            self.nth[at] = min(k, 3)
            head = (some >> 8 << 40) + (bits[some] >> rest)  # the code words that begin alike, of one context
            _, of = np.unique(head, return_inverse=True)
            ones = self.bit[at] > 0
            n = np.concatenate(groups)[some]
            zero, one = np.bincount(of, np.where(ones, 0, n)), np.bincount(of, np.where(ones, n, 0))
            self.odds[at] = np.clip(np.rint(np.log((one + 0.1) / (zero + 0.1)) / STEP), -127, 127).astype(np.int8)[of]

    def numbers(self, three: np.ndarray) -> np.ndarray:
        """Which code word a byte is: three has it in the lowest byte, and above it the two before."""
        three = three.astype(np.int64)
        return self.context.take(three >> 8 & 0xFFF) << 8 | three & 255


def flat(data: list[bytes], before: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All segments in one array with GAP bytes before each; where each starts, and ends."""
    size = np.array([len(x) for x in data], np.int64) + GAP
    ends = np.cumsum(size)
    gaps = [x.rjust(GAP, b"\0") for x in before] if before else [bytes(GAP)] * len(data)
    return np.frombuffer(b"".join(x for g, d in zip(gaps, data, strict=True) for x in (g, d)), np.uint8), ends - size + GAP, ends


def within(b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which bytes of a flat array are not in a gap."""
    inside = np.ones(len(b), bool)
    inside[(starts[:, None] - np.arange(1, GAP + 1)).ravel()] = False
    return inside


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _K[0]), dtype=np.uint64)


def _hash(x: np.ndarray, k: int) -> np.ndarray:
    h = x * _K[k]
    h ^= h >> np.uint64(31)
    h *= _K[0]
    h ^= h >> np.uint64(29)
    return h


def encoded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value which distinct one it is, and the distinct values."""
    which, kinds = pd.factorize(x)
    return which.astype(np.int32), kinds


def distinct(slots: np.ndarray) -> np.ndarray:
    """In order, once each; sorts its argument."""
    slots.sort()
    return slots[np.concatenate([[True], slots[1:] != slots[:-1]])] if len(slots) else slots


def places(known: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Where in known, distinct and in order, each slot is; all are there."""
    if not len(slots):
        return np.zeros(0, np.int32)
    least = known[0]
    span = int(known[-1] - least).bit_length()
    top = min(span, len(known).bit_length() + 1)
    shift = np.uint64(span - top)
    start = np.zeros((1 << top) + 1, np.int32 if len(known) < 1 << 30 else np.int64)
    x = known - least
    x >>= shift
    np.cumsum(np.bincount(x.view(np.int64), minlength=1 << top), dtype=start.dtype, out=start[1:])
    x = slots - least
    x >>= shift
    at = start.take(x.view(np.int64))
    del x, start
    wrong = np.flatnonzero(known.take(at) != slots)
    while len(wrong):
        at[wrong] += 1
        wrong = wrong[known.take(at[wrong]) != slots[wrong]]
    return at


# states: what is known of a slot, in a byte

_FEW, STEP = 14, 0.0625


def _states() -> tuple[np.ndarray, np.ndarray]:
    """The state of each pair of few counts; and the log odds of each state, in steps of STEP."""
    pairs = [(a, b) for a in range(_FEW + 1) for b in range(_FEW + 1 - a)]
    number, logit = np.zeros((_FEW + 1, _FEW + 1), np.uint8), np.zeros(256)
    for k, (a, b) in enumerate(pairs):
        number[a, b], logit[k] = k, np.log((b + 0.1) / (a + 0.1))
    logit[len(pairs) :] = (np.arange(MANY) - MANY // 2) * 2 * STEP
    return number, np.clip(np.rint(logit / STEP), -127, 127).astype(np.int8)


MANY = 256 - (_FEW + 1) * (_FEW + 2) // 2  # states of more counts, by their log odds
PAIR, LOGIT = _states()


def states(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    few = zeros + ones <= _FEW
    steps = np.rint(np.log((ones + np.float32(0.1)) / (zeros + np.float32(0.1))) / (2 * STEP))
    out = (np.clip(steps, -(MANY // 2), MANY - MANY // 2 - 1) + (256 - MANY + MANY // 2)).astype(np.uint8)
    out[few] = PAIR[zeros[few], ones[few]]
    return out


@dataclass
class Lot:
    """Segments of texts as they are scored: for each its text's id and number, whether it may be learnt from, what stands before it, whether it is the text's last, and the hashes of its words where they can't be read off it."""

    docs: list[int | None] = field(default_factory=list)
    numbers: list[int] = field(default_factory=list)
    train: list[bool] = field(default_factory=list)
    before: list[bytes] = field(default_factory=list)
    data: list[bytes] = field(default_factory=list)
    last: list[bool] = field(default_factory=list)
    words: list[np.ndarray | None] = field(default_factory=list)

    def word_hashes(self) -> list[np.ndarray]:
        read = word_hashes([b"" if w is not None else d[:-1] if end else d for d, w, end in zip(self.data, self.words, self.last, strict=True)])
        return [r if w is None else w for r, w in zip(read, self.words, strict=True)]


@functools.cache
def settled() -> None:
    """Has glibc, in this worker, make arrays under HEAP bytes from memory that was used before and not give that back in between: to map each anew costs a fifth of the CPU. Elsewhere nothing."""
    library = ctypes.CDLL(None)
    if hasattr(library, "mallopt"):
        for option, size in ((-3, HEAP), (-1, 8 * HEAP)):  # from where on an array is a mapping of its own; and what may stay free at the end
            library.mallopt(option, size)


class Events:
    """The bits of a lot's units, which are its distinct words with what ends them and the three bytes before; and which unit each word is."""

    def __init__(self, lot: Lot, code: Code, table_bits: int, counted: bool = True) -> None:
        """counted: whether met() is to be asked, else what it needs is not made."""
        self.code = code
        b, starts, ends = flat(lot.data, lot.before)
        token_start, token_end, tokens = _tokens(b, starts, ends)
        self.unit, rep = _units(b, token_start, token_end)
        #: How many words each segment has, and how often each unit is in texts that may be learnt from.
        self.tokens = tokens
        self.counts = np.bincount(self.unit[np.repeat(lot.train, tokens)], minlength=len(rep)) if counted else None
        start, length = token_start[rep], (token_end - token_start)[rep]
        powers = _powers(int(length.max(initial=1)))
        ends = np.concatenate([[0], np.cumsum(length)])
        six, pair = np.empty(ends[-1], np.uint64), np.empty(ends[-1], np.uint64)  # six bytes; and the word so far with three bytes
        #: Of each byte of a unit: how many bits, where they begin in the code's arrays, and the gate, with two bits more for the place in the code and the bit.
        self.bits, self.place, self.gate = (np.empty(ends[-1], t) for t in (np.uint8, np.int32, np.uint8))
        for i in range(0, len(rep), CHUNK):  # so that what is made at a time stays near the processor
            some, into = slice(i, i + CHUNK), slice(ends[i], ends[min(i + CHUNK, len(rep))])
            many = length[some]
            before = np.cumsum(many) - many
            at = np.repeat(start[some] - before, many)
            at += np.arange(len(at))
            nth = np.arange(len(at)) - np.repeat(before, many)  # place in the word
            own = b.take(at).astype(np.uint64)
            value = own.copy()
            for k in range(1, 6):
                more = b.take(at - k)
                if k > 3:
                    more[nth < k - 3] = 0
                value |= more.astype(np.uint64) << np.uint64(8 * k)
            six[into] = value
            three = value & np.uint64(0xFFFFFF)
            number = code.numbers(three)
            self.bits[into] = code.length.take(number)
            self.place[into] = code.start.take(number)
            self.gate[into] = np.minimum(nth, 7).astype(np.uint8) << np.uint8(3)
            own += np.uint64(1)
            own *= powers.take(nth)
            total = np.zeros(len(own) + 1, np.uint64)
            np.cumsum(own, dtype=np.uint64, out=total[1:])
            pair[into] = _paired(total[:-1] - np.repeat(total.take(before), many), three)  # of what is before in the word
        del b, token_start, token_end, tokens, rep, start, powers
        #: How many bits each unit is, and where they begin.
        sums = np.concatenate([[0], np.cumsum(self.bits, dtype=np.int64)])
        self.first = sums.take(ends[:-1])
        self.size = sums.take(ends[1:]) - self.first
        del sums, ends
        to_word, heads = encoded(pair)
        del pair
        low = np.zeros(len(heads), np.uint64)
        low[to_word] = six
        low &= np.uint64(0xFFFFFF)
        heads = _hash(_unpaired(heads, low) + np.uint64(7), 3)
        to_six, kinds = encoded(six)
        del six
        #: By order: which distinct context each byte of a unit has, where the bits of that begin, and each bit's slot, bit and how often it is to be counted.
        self.orders = []
        for of, h, last in ((to_word, heads, low), (to_six, _hash((kinds >> np.uint64(8)) + np.uint64(3), 2), kinds & np.uint64(0xFFFFFF))):
            number = code.numbers(last)
            many = code.length.take(number)
            first = np.cumsum(many) - many
            place = np.repeat(code.start.take(number) - first, many)
            place += np.arange(len(place))
            bit = code.bit.take(place) if counted else None
            slot = np.repeat(h, many)
            slot += code.node.take(place)
            del place
            slot *= _K[4]
            slot ^= slot >> np.uint64(32)
            slot *= _K[2]
            slot >>= np.uint64(64 - table_bits)
            self.orders.append((of, first.astype(np.int32), slot, bit, np.repeat(self._times(of, length, len(number)).astype(np.uint32), many) if counted else None))

    def _times(self, of: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
        """How often each distinct context is in texts that may be learnt from."""
        out, at = np.zeros(n), 0
        for i in range(0, len(length), 16 * CHUNK):
            weight = np.repeat(self.counts[i : i + 16 * CHUNK].astype(float), length[i : i + 16 * CHUNK])
            out += np.bincount(of[at : at + len(weight)], weight, n)
            at += len(weight)
        return out

    def met(self, last: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The distinct slots in order, and how many zeros and ones the bits that count gave each. last: the events are used up, so that a task holds less."""
        known = distinct(np.concatenate([o[2] for o in self.orders]))
        n = np.zeros(2 * len(known), np.uint32)
        orders = self.orders if last else [*self.orders]
        while orders:
            _, _, slot, bit, times = orders.pop()
            at = places(known, slot)
            del slot
            at <<= 1
            at += bit
            for k in range(0, len(known), 1 << 20):  # so that nothing of the whole length is made besides
                some = (at >= 2 * k) & (at < 2 * k + (2 << 20))
                n[2 * k : 2 * k + (2 << 20)] += np.bincount(at[some] - 2 * k, times[some], min(2 << 20, len(n) - 2 * k)).astype(np.uint32)
            del at, bit, times
        return known, n.reshape(-1, 2).T

    def predicted(self, found: np.ndarray) -> np.ndarray:
        """found: the state of each distinct slot in order. For each bit of the units four bytes: the log odds by word, by five bytes and by two, each of the other bit, and gate and bit."""
        known = distinct(np.concatenate([o[2] for o in self.orders]))
        value = LOGIT.take(found)
        by = [value.take(places(known, slot)) for _, _, slot, _, _ in self.orders]
        out = np.empty((int(self.bits.sum(dtype=np.int64)), 4), np.int8)
        done = 0
        for i in range(0, len(self.bits), 4 * CHUNK):
            some = slice(i, i + 4 * CHUNK)
            bits = self.bits[some].astype(np.int64)
            ends = np.cumsum(bits)
            step, before = np.arange(int(ends[-1])), ends - bits

            def each(first: np.ndarray, bits: np.ndarray = bits, before: np.ndarray = before, step: np.ndarray = step) -> np.ndarray:
                at = np.repeat(first - before, bits)
                at += step
                return at

            into = out[done : (done := done + len(step))]
            for k, ((to, first, _, _, _), own) in enumerate(zip(self.orders, by, strict=True)):
                into[:, k] = own.take(each(first.take(to[some])))
            place = each(self.place[some])
            into[:, 2] = self.code.odds.take(place)
            gate = np.repeat(self.gate[some], bits)
            gate |= self.code.nth.take(place) << np.uint8(1)
            gate |= self.code.bit.take(place)
            into[:, 3] = gate.view(np.int8)
            sign = np.array([1, -1], np.int8).take(gate & np.uint8(1))
            for k in range(3):  # here, as units are fewer than words
                into[:, k] *= sign
        return out.view(np.uint32).ravel()


def _tokens(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins, and ends after the space or end byte; and how many each segment has."""
    last = ((b == 32) | (b == 0)) & within(b, starts)
    last[ends - 1] = True  # a word that is cut, too
    token_end = np.flatnonzero(last) + 1
    through = np.searchsorted(token_end, ends) + 1
    token_start = np.concatenate([[0], token_end[:-1]])
    token_start[np.concatenate([[0], through[:-1]])] = starts
    return token_start, token_end, np.diff(through, prepend=0)


def _units(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word which distinct one it is, with the three bytes before it; and for each distinct one a word that is it."""
    joined = b.tobytes() + bytes(8)
    eight = np.ndarray(len(b) + 1, "<u8", joined, strides=(1,))  # the eight bytes from each place
    length = end - start
    name = np.empty(len(start), np.uint64)
    for i in range(0, len(start), 4 * CHUNK):
        begin, many = start[i : i + 4 * CHUNK], length[i : i + 4 * CHUNK]
        own = (many.astype(np.uint64) << np.uint64(24) | (eight[begin - 3] & _FIRST[3])) * np.uint64(0x9E3779B97F4A7C15)
        some = np.arange(len(begin))
        for at in range(0, _LONG, 8):
            some = some[many[some] > at] if at else some
            if not len(some):
                break
            h = (own[some] ^ (eight[begin[some] + at] & _FIRST.take(np.minimum(many[some] - at, 8)))) * np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x165667B19E3779F9)
            own[some] = h ^ (h >> np.uint64(32))
        for k in np.flatnonzero(many > _LONG).tolist():
            own[k] = xxhash.xxh3_64_intdigest(joined[begin[k] - 3 : begin[k] + many[k]])
        name[i : i + 4 * CHUNK] = own
    which, known = encoded(name)
    rep = np.zeros(len(known), np.int64)
    rep[which] = np.arange(len(which))
    return which, rep


_BACK = pow(int(_K[2]), -1, 1 << 64)


def _paired(word: np.ndarray, three: np.ndarray) -> np.ndarray:
    """One number for a word's hash and three bytes, from which either gives the other."""
    out = three * _K[1]
    out ^= word
    out *= _K[2]
    out ^= out >> np.uint64(32)
    return out


def _unpaired(pair: np.ndarray, three: np.ndarray) -> np.ndarray:
    """The word's hash."""
    out = pair ^ (pair >> np.uint64(32))
    out *= np.uint64(_BACK)
    out ^= three * _K[1]
    return out


def _groups(data: list[bytes], most: int) -> Iterator[tuple[int, list[bytes]]]:
    """Segments together until they reach `most` bytes, and the number of the first."""
    start, size = 0, 0
    for k, x in enumerate(data):
        if k > start and size + len(x) > most:
            yield start, data[start:k]
            start, size = k, 0
        size += len(x)
    if data:
        yield start, data[start:]


def stride_at(t: int) -> int:
    """Bits from the place t of a segment to the next change of its weights: STRIDE at first, later a part of what was read."""
    return max(STRIDE, t // 1024 * STRIDE)


def refined(bits: np.ndarray, first: np.ndarray, start: tuple[float, ...] = START, rate: float = RATE) -> np.ndarray:
    """Natural log probability of each segment, whose bits (of Events.predicted) begin at first (one more than segments). All segments take a stride at a time together."""
    sizes = np.diff(first)
    longest_first = np.argsort(-sizes, kind="stable")  # so that those which go on are the first
    begin, size = first[:-1][longest_first], sizes[longest_first]
    n = len(size)
    own = [np.full(n * GATES, w * STEP, np.float32) for w in start]  # by segment and gate
    out, t = np.zeros(n), 0
    while n and t < size[0]:
        stride = stride_at(t)
        live = int(np.searchsorted(-size, -t))
        at = (begin[:live, None] + t) + np.arange(stride)
        over = (np.arange(t, t + stride) >= size[:live, None]).ravel() if size[live - 1] < t + stride else None
        four = bits.take(at.ravel(), mode="clip").view(np.int8).reshape(-1, 4)
        x = [four[:, k].astype(np.float32) for k in range(3)]
        g = (four[:, 3].view(np.uint8) >> np.uint8(1)).astype(np.intp).reshape(live, stride)
        g += (np.arange(live) * GATES)[:, None]
        g = g.ravel()
        z = own[0].take(g)
        z *= x[0]
        for k in (1, 2):
            y = own[k].take(g)
            y *= x[k]
            z += y
        np.clip(z, -11, 11, out=z)
        np.exp(z, out=z)  # the odds against the bit
        wrong = z + np.float32(1)
        z /= wrong
        np.log(wrong, out=wrong)
        if over is not None:
            wrong[over] = 0
            z[over] = 0
        out[:live] -= wrong.reshape(live, stride).sum(1, dtype=np.float64)
        t += stride
        on = int(np.searchsorted(-size, -t))  # those that have more bits
        if on and rate:
            speed, some = np.float32(-rate * STEP * STEP * (STRIDE / stride) ** 0.5), slice(on * stride)
            for k in range(3):
                own[k][: on * GATES] += speed * np.bincount(g[some], z[some] * x[k][some], on * GATES).astype(np.float32)
    back = np.empty(n)
    back[longest_first] = out
    return back


def scores(lot: Lot, events: Events, found: np.ndarray, start: tuple[float, ...] = START, rate: float = RATE) -> np.ndarray:
    """log10 probability of each segment of a lot."""
    out, bits, token = [], events.predicted(found), 0
    for i, group in _groups(lot.data, PIECE):
        tokens = events.tokens[i : i + len(group)]
        unit = events.unit[token : (token := token + int(tokens.sum()))]
        ends = np.concatenate([[0], np.cumsum(events.size.take(unit))])
        own = np.empty(ends[-1], np.uint32)
        for k in range(0, len(unit), CHUNK):
            some = unit[k : k + CHUNK]
            size = events.size.take(some)
            at = np.repeat(events.first.take(some) - ends[k : k + len(some)], size)
            at += np.arange(ends[k], ends[k + len(some)])
            bits.take(at, out=own[ends[k] : ends[k + len(some)]], mode="clip")
        out.append(refined(own, ends[np.concatenate([[0], np.cumsum(tokens)])], start, rate) / np.log(10))
    return np.concatenate(out) if out else np.zeros(0)


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # keeps so many bytes of eight
_LONG = 64


def word_hashes(data: list[bytes]) -> list[np.ndarray]:
    """Hashes of the words of each text, A-Z in lower case: eight bytes at a time, for all words at once."""
    joined = b"\n".join([b"", *(t.lower() for t in data), bytes(8)])
    b = np.frombuffer(joined, np.uint8)
    space = _SPACE.take(b[:-8])
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    length = ends - starts
    eight = np.ndarray(len(b) - 7, "<u8", joined, strides=(1,))  # the eight bytes from each place
    name = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    some = np.arange(len(starts))
    for at in range(0, _LONG, 8):
        some = some[length[some] > at] if at else some
        if not len(some):
            break
        h = (name[some] ^ (eight[starts[some] + at] & _FIRST.take(np.minimum(length[some] - at, 8)))) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x165667B19E3779F9)
        name[some] = h ^ (h >> np.uint64(32))
    for k in np.flatnonzero(length > _LONG).tolist():
        name[k] = xxhash.xxh3_64_intdigest(joined[starts[k] : ends[k]])
    offsets = np.cumsum([1, *(len(t) + 1 for t in data)])
    cut = np.searchsorted(starts, offsets)
    return [name[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


@functools.cache
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One pair for each worker process."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(x: np.ndarray) -> bytes:
    """Numbers as one plane for each of their bytes, compressed; planes of zeros at the end are left out."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T) if len(x) else np.zeros((0, 0), np.uint8)
    used = len(planes)
    while used and not planes[used - 1].any():
        used -= 1
    return bytes([used]) + len(x).to_bytes(5, "little") + (_zstd()[0].compress(planes[:used].tobytes()) if used else b"")


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    used, n = blob[0], int.from_bytes(blob[1:6], "little")
    out = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    if used:
        out[:, :used] = np.frombuffer(_zstd()[1].decompress(blob[6:]), np.uint8).reshape(used, n).T
    return out.view(kind).ravel()


def lots_of(rows: DataFrame, most: int) -> DataFrame:
    """rows: doc_id, text, train. Segments together until they reach `most` bytes; and how many texts and tokens that may be learnt from begin in each lot; in a task's last lot, how often which byte follows which two in all of the task's."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, number, lot, size, learnt, tokens = TaskContext.get().partitionId(), 0, 0, Lot(), 0, 0, 0
        triples = np.zeros(1 << 20, np.int64)

        def made(last: bool = False) -> pa.RecordBatch:
            b, starts, ends = flat(lot.data, lot.before)
            x = b.astype(np.int32)
            x[2:] |= x[1:-1] << 8 | (x[:-2] & 15) << 16  # the right side is made of x as it was
            np.add(triples, np.bincount(x[within(b, starts)], minlength=1 << 20), out=triples)
            some = np.flatnonzero(triples) if last else np.zeros(0, np.int64)
            blob = zstandard.ZstdCompressor(level=3).compress(pickle.dumps(lot))
            return pa.RecordBatch.from_arrays([pa.array([task << 32 | n], pa.int64()), pa.array([-1], pa.int64()), pa.array([blob], pa.binary()), pa.array([learnt], pa.int64()), pa.array([tokens], pa.int64()), pa.array([_packed(some)], pa.binary()), pa.array([_packed(triples[some])], pa.binary())], names=["lot", "shard", "blob", "learnt", "tokens", "triples", "times"])

        for b in batches:
            for doc, train, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "train")), as_bytes(b.column("text")), strict=True):
                text = normalised(raw)
                parts = segments(text)
                cut_words = not all(x.endswith(b" ") for x in parts[:-1])
                at = 0
                for k, part in enumerate(parts):
                    if lot.data and size + len(part) > most:
                        yield made()
                        n, lot, size, learnt, tokens = n + 1, Lot(), 0, 0, 0
                    words = None if not cut_words else np.empty(0, np.uint64) if k else word_hashes([text[:-1]])[0]
                    for column, value in zip(vars(lot).values(), (doc, task << 32 | number, bool(train), text[max(0, at - GAP) : at], part, k == len(parts) - 1, words), strict=True):
                        column.append(value)
                    size, at = size + len(part), at + len(part)
                    if train and not k:
                        learnt, tokens = learnt + 1, tokens + (text.count(b" ") + 2 if len(text) > 1 else 1)
                number += 1
        if lot.data:
            yield made(True)

    return stored(map_batches(rows, gather, "lot bigint, shard bigint, blob binary, learnt bigint, tokens bigint, triples binary, times binary"), "lots")


def _lot(blob: bytes) -> Lot:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def code_for(lots: DataFrame) -> Code:
    """The prefix codes that suit all texts, by how often each byte follows which two."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 20, np.int64)
        for b in batches:
            for triples, times in zip(b.column("triples").to_pylist(), b.column("times").to_pylist(), strict=True):
                total[_unpacked(triples, np.int64)] += _unpacked(times, np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["triple", "n"])

    rows = map_batches(lots.select("triples", "times"), read, "triple int, n bigint").groupBy("triple").sum("n").collect()  # 2 ** 20 at most
    counts = np.zeros(1 << 20)
    for triple, n in rows:
        counts[triple] = n
    return Code(counts.reshape(16, 256, 256))


def answered(lots: DataFrame, code: Code, table_bits: int, parts: int, tasks: int, many: int) -> DataFrame:
    """For whole_lots(): each lot, and after it in pieces the states of its distinct slots in order, and how often the texts that may be learnt from have each of its distinct words in order; v adds up to the number of such words. tasks, many: how many tasks made the lots, and how many lots there are; each meets its answers in a partition of its own where tasks made alike many."""
    shared = lots.sparkSession.sparkContext.broadcast(code)
    shard_bits = max(5, (2 * parts - 1).bit_length())  # as the tasks that ask grow, so do those that answer
    shift, word_shift = np.uint64(table_bits - shard_bits), np.uint64(64 - shard_bits)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled()
        for b in batches:
            for number, blob in zip(b.column("lot").to_pylist(), b.column("blob"), strict=True):
                lot = _lot(blob.as_py())
                slot, n = Events(lot, shared.value, table_bits).met(last=True)
                each = lot.word_hashes()
                of, word = encoded(np.concatenate(each))
                times = np.bincount(of, np.repeat(np.array(lot.train, float), [len(x) for x in each]), len(word)).astype(np.uint32)
                order = np.argsort(word)
                word, times = word[order], times[order]
                shards = np.arange(1 << shard_bits, dtype=np.uint64)
                ends, word_ends = np.searchsorted(slot >> shift, shards, "right"), np.searchsorted(word >> word_shift, shards, "right")
                for k, (i, j, p, q) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), [0, *word_ends[:-1].tolist()], word_ends.tolist(), strict=True)):
                    if i < j or p < q:
                        blobs = (np.diff(slot[i:j], prepend=np.uint64(k) << shift), n[:, i:j].ravel(), np.diff(word[p:q], prepend=np.uint64(k) << word_shift), times[p:q])
                        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([k], pa.int64()), *(pa.array([_packed(x)], pa.binary()) for x in blobs)], names=["lot", "shard", "slots", "n", "words", "times"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def keys(column: int, by: np.uint64) -> tuple[np.ndarray, np.ndarray, list[int]]:
            """The distinct keys, which of them each row's are, and where a row's end."""
            each = [np.cumsum(_unpacked(row[column], np.uint64), dtype=np.uint64) for row in held]
            every = np.concatenate(each)
            every += np.uint64(shard) << by
            known = distinct(every.copy())
            return known, places(known, every), np.cumsum([len(x) for x in each]).tolist()

        def made() -> Iterator[pa.RecordBatch]:
            known, at, ends = keys(1, shift)
            n = [_unpacked(row[2], np.uint32).reshape(2, -1) for row in held]
            found = states(*(np.bincount(at, np.concatenate([x[k] for x in n]), len(known)).astype(np.int64) for k in (0, 1))).take(at)
            known, at, word_ends = keys(3, word_shift)
            times = np.bincount(at, np.concatenate([_unpacked(row[4], np.uint32) for row in held]), len(known)).astype(np.int64)
            v, times, i, j = int((times > 0).sum()), times.take(at), 0, 0
            for k, (row, end, word_end) in enumerate(zip(held, ends, word_ends, strict=True)):
                blobs = (_packed(found[i:end]), _packed(times[j:word_end]))
                i, j = end, word_end
                yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), pa.array([shard], pa.int64()), *(pa.array([x], pa.binary()) for x in blobs), pa.array([0 if k else v], pa.int64())], names=["lot", "shard", "blob", "times", "v"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("lot", "shard", "slots", "n", "words", "times")), strict=True):
                if row[1] != shard and held:
                    yield from made()
                    held = []
                shard = row[1]
                held.append((row[0], *row[2:]))
        if held:
            yield from made()

    asked = map_batches(lots.select("lot", "blob"), ask, "lot bigint, shard bigint, slots binary, n binary, words binary, times binary")
    answers = map_batches(asked.repartitionById(1 << shard_bits, F.col("shard").cast("int")).sortWithinPartitions("shard", "lot"), answer, "lot bigint, shard bigint, blob binary, times binary, v bigint")
    whole = lots.select("lot", "shard", "blob", F.lit(None).cast("binary").alias("times"), F.lit(0).cast("bigint").alias("v")).union(answers)
    own = F.pmod(F.shiftright("lot", 32) + F.col("lot").bitwiseAND((1 << 32) - 1) * tasks, F.lit(max(1, many))).cast("int")
    return whole.repartitionById(max(1, many), own).sortWithinPartitions("lot", "shard").select("lot", "shard", "blob", "times", "v")


def whole_lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Lot, np.ndarray, np.ndarray, int]]:
    """From rows of answered(): each lot, the states of its distinct slots in order, the counts of its distinct words in order, and its part of v."""
    number, lot, found, times, v = None, None, [], [], 0

    def made() -> tuple[Lot, np.ndarray, np.ndarray, int]:
        return lot, np.concatenate([_unpacked(x, np.uint8) for x in found]), np.concatenate([_unpacked(x, np.int64) for x in times]), v

    for b in batches:
        for nth, shard, own, count, kinds in zip(b.column("lot").to_pylist(), b.column("shard").to_pylist(), b.column("blob"), b.column("times"), b.column("v").to_pylist(), strict=True):
            if nth != number:
                if number is not None:
                    yield made()
                number, found, times, v = nth, [], [], 0
            if shard < 0:
                lot = _lot(own.as_py())
            else:
                found.append(own.as_py())
                times.append(count.as_py())
                v += kinds
    if number is not None:
        yield made()


def scored(docs: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of each row. learn_from: on doc_id, which rows are learnt from."""
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).withColumn("train", F.lit(True) if learn_from is None else learn_from)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    table_bits = max(LEAST_BITS, int(np.ceil(np.log2(max(1, size) * SLOTS))))
    with batch_rows(spark, 512):
        lots = lots_of(rows, int(np.clip(size // SPREAD, LEAST_LOT, LOT)))
    ends, n, tasks, many = lots.agg(F.coalesce(F.sum("learnt"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.max(F.shiftright("lot", 32)), F.lit(0)) + 1, F.count(F.lit(1))).first()
    code = code_for(lots)
    shared = spark.sparkContext.broadcast(code)
    end, known_end = np.log10(ends + 1), 1 if ends else 0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled()
        for lot, found, counts, v in whole_lots(batches):
            value = scores(lot, Events(lot, shared.value, table_bits, counted=False), found)
            each = lot.word_hashes()
            many = np.array([len(x) for x in each], np.int64)
            word = np.concatenate(each)
            times = counts[places(distinct(word.copy()), word)]
            of, last = np.repeat(np.arange(len(each)), many), np.array(lot.last, np.int64)
            base, known = np.bincount(of, np.log10(times + 1.0), len(each)) + last * end, np.bincount(of, times > 0, len(each)) + last * known_end
            columns = [pa.array(lot.docs, pa.int64()), pa.array(lot.numbers, pa.int64()), pa.array(lot.train, pa.bool_()), pa.array([not x and y for x, y in zip(lot.before, lot.last, strict=True)], pa.bool_()), pa.array(many + last), pa.array(known.astype(np.int64)), pa.array(base), pa.array(value), pa.array([len(x) for x in lot.data], pa.int64()), pa.array([v, *[0] * (len(each) - 1)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "number", "train", "whole", "n_tokens", "n_known", "base", "score", "bytes", "v"])

    with batch_rows(spark, 64):  # a lot is a few MB
        made = stored(map_batches(answered(lots, code, table_bits, parts, tasks, many), score, "doc_id bigint, number bigint, train boolean, whole boolean, n_tokens bigint, n_known bigint, base double, score double, bytes bigint, v bigint"), "scores")
    dropped(lots)
    v = (made.agg(F.sum("v")).first()[0] or 0) + known_end
    columns = ("doc_id", "train", "n_tokens", "n_known", "base", "score", "bytes")
    long = made.filter("NOT whole").groupBy("number").agg(F.first("doc_id").alias("doc_id"), F.first("train").alias("train"), *[F.sum(c).alias(c) for c in columns[2:]])
    each = made.filter("whole").select(*columns).union(long.select(*columns))
    return each.select(
        "doc_id", "train", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        "score", (-F.col("score") * F.lit(float(np.log2(10))) / F.col("bytes")).alias("bits_per_byte"),
    )


def op10_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scored(documents(spark, sf_dir), fold("doc_id", 7) != 2)
    return got.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
