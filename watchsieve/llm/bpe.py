"""Byte-pair encoding and decoding, with text encoded as a tree.

A text over LEAF characters is halved again and again, wherever its middle is, and the leaves are encoded, in parallel from
PARALLEL leaves on (handing over fewer takes longer). Where
two sides meet, the tokens around the join are encoded anew, in a window that grows until both its ends are places that
either side cuts in any surroundings: where white space follows something else, the pattern that splits text always ends a
piece, and what lies beyond is as it was. A window that finds no such place goes on to the end of its side, so the result is
that of the whole text. A piece over PIECE bytes is encoded as a tree of its own: its leaves in parallel, then at each join
the tokens around it are encoded anew, in a window that grows until its first and last token are those that both sides had.
Each pair of neighbours in the result then stands in some correct encoding, which is what makes the whole one correct.

Defined results: null text counts as empty, and an empty text has no tokens and decodes to itself; the string of a special
token becomes that token, as the tokenizers library does by default; a null id is kept; repeated rows get a row each;
other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from .common import documents, map_batches, texts

LEAF, PIECE, THREADS, PARALLEL = 1 << 11, 1 << 12, 2, 16
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACE = frozenset(b" \t\n\x0b\x0c\r")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _pool() -> ThreadPoolExecutor:
    """One for each worker process; the encoder lets other threads run."""
    return ThreadPoolExecutor(THREADS)


class Codec:
    """A byte-level BPE vocabulary in the tokenizers library's JSON form."""

    def __init__(self, path: str, leaf: int = LEAF, piece: int = PIECE) -> None:
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self._byte = dict(zip(map(chr, plain), plain, strict=True)) | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(self._byte[c] for c in token): i for token, i in made["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in made["added_tokens"] if t["special"]}
        ranks = {k: v for k, v in ranks.items() if v not in self.special.values()}
        self._bpe = tiktoken.Encoding(base64.b16encode(path.encode()).decode(), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._bytes = [b""] * (1 + max([*ranks.values(), *self.special.values()]))
        for token, i in ranks.items():
            self._bytes[i] = token
        for token, i in self.special.items():
            self._bytes[i] = token.encode()
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._pieces = regex.compile(PATTERN)
        self.leaf, self.piece = leaf, piece
        #: Joins made so far, and tokens encoded anew at them.
        self.joins = self.again = 0

    def encode(self, text: str) -> list[int]:
        if self._special and any(s in text for s in self.special):
            return [i for k, part in enumerate(self._special.split(text)) for i in ([self.special[part]] if k % 2 else self._plain(part))]
        return self._plain(text)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace").encode()

    def _plain(self, text: str) -> list[int]:
        return self._leaf(text) if len(text) <= self.leaf else self._joined(text)

    def _joined(self, text: str) -> list[int]:
        n = 1 << (-(-len(text) // self.leaf) - 1).bit_length()
        ends = [len(text) * k // n for k in range(n + 1)]
        leaves = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        sides = list((_pool().map if n >= PARALLEL else map)(self._leaf, leaves))
        while len(sides) > 1:
            sides = [self.weld(*sides[k : k + 2]) for k in range(0, len(sides), 2)]
        return sides[0]

    def _leaf(self, text: str) -> list[int]:
        if len(text) <= self.piece:
            return self._bpe.encode_ordinary(text)
        return [i for m in self._pieces.finditer(text) for i in self.tree(m.group().encode())]

    def _apart(self, tokens: list[int], k: int) -> bool:
        """Whether a piece ends before the token k in any surroundings: white space stands there, and something else before it."""
        if self._bytes[tokens[k]][0] not in _SPACE:
            return False
        last = self._bytes[tokens[k - 1]][-1]
        if last < 128:
            return 32 < last < 127
        tail = b"".join(self._bytes[i] for i in tokens[max(0, k - 4) : k])[-4:].decode("utf-8", "ignore")
        return bool(tail) and tail[-1].isalnum()

    def weld(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two texts one after the other, from those of each."""
        a, b = len(left), 0
        while a > 0:
            a -= 1
            if a == 0 or self._apart(left, a):
                break
        while b < len(right):
            b += 1
            if b == len(right) or self._apart(right, b):
                break
        self.joins += 1
        window = self._leaf(b"".join(self._bytes[i] for i in (*left[a:], *right[:b])).decode())
        self.again += len(window)
        left[a:] = window
        left += right[b:]
        return left

    def tree(self, piece: bytes) -> list[int]:
        """The encoding of one piece that the pattern does not split."""
        if len(piece) <= self.piece:
            return self._bpe._encode_single_piece(piece)
        n = -(-len(piece) // self.piece)
        ends = [len(piece) * k // n for k in range(n + 1)]
        sides = [self._bpe._encode_single_piece(piece[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
        while len(sides) > 1:
            sides = [self.join(*sides[k : k + 2]) if k + 1 < len(sides) else sides[k] for k in range(0, len(sides), 2)]
        return sides[0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        self.joins += 1
        k = 4
        while True:
            a, b = max(0, len(left) - k), min(k, len(right))
            window = self._bpe._encode_single_piece(b"".join(self._bytes[i] for i in (*left[a:], *right[:b])))
            if (a == 0 or window[0] == left[a]) and (b == len(right) or window[-1] == right[b - 1]):
                return [*left[:a], *window, *right[b:]]
            k *= 2


@functools.cache
def codec(path: str) -> Codec:
    """One for each worker process."""
    return Codec(path)


def encoded(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids array<int>, of every text."""
    path = path or vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([c.encode(t) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return map_batches(texts(docs, id_col, text_col), encode, "doc_id bigint, ids array<int>")


def digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text; the count and digest of its ids, the digest of what they decode to, and how many joins its encoding took."""
    path = path or vocabulary()

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            n, ids_sha, text_sha, joins = [], [], [], []
            for t in b.column("text"):
                before = c.joins
                ids = c.encode(t.as_py())
                joins.append(c.joins - before)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(joins, pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_joins"])

    return map_batches(texts(docs, id_col, text_col), both, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_joins bigint")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
