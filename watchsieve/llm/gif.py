"""GIF media: LZW code streams, palettes, disposal and transparency, and timed frames with colour histograms.

The decoder reads GIF87a and GIF89a: several frames, global and local palettes, interlaced rows, transparent indices, and
the three ways of disposal. Codes are taken from the bit stream a few thousand at a time, as their widths follow from how
many came since the last clear code; a code's string is always a slice of what has been written already. The encoder
writes ordinary LZW with clear codes at a full table.

Defined results: a null or damaged GIF gives one row with a null frame and its error; an empty or null text is stored as
64 zero bytes; a payload larger than one frame is several frames, so none outgrows the format; repeated rows get rows
each; a null id is kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, documents, map_batches, texts

WIDTH, ROWS, DELAY = 64, 4096, 10
GREY = bytes(x for i in range(256) for x in (i, i, i))
_BATCH = 4096
_widths: dict[int, np.ndarray] = {}


def widths(bits: int) -> np.ndarray:
    """Width of each code since the last clear code, for the first _BATCH of them; later ones have 12 bits."""
    if bits not in _widths:
        known = np.arange(_BATCH) + (1 << bits) + 1
        known[0] += 1
        _widths[bits] = np.clip(np.floor(np.log2(known)).astype(np.int64) + 1, bits + 1, 12)
    return _widths[bits]


def lzw_codes(data: bytes, bits: int = 8) -> list[int]:
    clear = 1 << bits
    out, table, new = [clear], {}, clear + 2
    if data:
        add, get = out.append, table.get
        rest = iter(data)
        word = next(rest)
        for c in rest:
            key = word << 8 | c
            if (found := get(key)) is not None:
                word = found
                continue
            add(word)
            word = c
            if new < 4096:
                table[key] = new
                new += 1
            else:
                add(clear)
                table.clear()
                new = clear + 2
        add(word)
    out.append(clear + 1)
    return out


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    codes = np.array(lzw_codes(data, bits), np.int64)
    starts = np.flatnonzero(codes == 1 << bits)
    since = np.arange(len(codes)) - np.repeat(starts, np.diff([*starts, len(codes)])) - 1  # -1 at a clear code itself
    # a clear code has the width that the next code of the part before it would have
    since[starts[1:]] = since[starts[1:] - 1] + 1
    since[0] = 0
    width = widths(bits)[np.minimum(since, _BATCH - 1)]
    at = np.cumsum(width) - width
    size = int(at[-1] + width[-1] + 7) // 8
    value = codes << (at & 7)
    out = sum(np.bincount((at >> 3) + k, weights=(value >> 8 * k) & 255, minlength=size + 2) for k in range(3))
    return out[:size].astype(np.uint8).tobytes()


def lzw_decode(data: bytes, bits: int, size: int) -> bytes:
    """The first size bytes that the code stream stands for."""
    clear, stream = 1 << bits, np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.int64)
    end, at, since, made = len(data) * 8, 0, 0, 0
    part: list[np.ndarray] = []  # codes since the last clear code
    out: list[bytes] = []
    fixed = np.full(_BATCH, 12, np.int64)
    while made < size and at + bits < end:
        most = min(_BATCH, (end - at) // (bits + 1))
        width = widths(bits)[:most] if since == 0 else fixed[:most] if since >= _BATCH else np.concatenate([widths(bits)[since:], fixed[:since]])[:most]
        pos = np.cumsum(width) + (at - width)
        if pos[-1] + width[-1] > end:
            pos = pos[pos + width <= end]
            if not len(pos):
                break
            width = width[: len(pos)]
        low = pos >> 3
        codes = ((stream[low] | stream[low + 1] << 8 | stream[low + 2] << 16) >> (pos & 7)) & ((1 << width) - 1)
        stops = np.flatnonzero((codes >> 1) == clear >> 1)
        if not len(stops):
            part.append(codes)
            at, since = int(pos[-1] + width[-1]), since + len(codes)
            continue
        n = int(stops[0])
        out.append(_strings(np.concatenate([*part, codes[:n]]), clear))
        made += len(out[-1])
        at, since, part = int(pos[n] + width[n]), 0, []
        if codes[n] == clear + 1:
            break
    if part:
        out.append(_strings(np.concatenate(part), clear))
        made += len(out[-1])
    if made < size:
        raise ValueError("the code stream ends early")
    return b"".join(out)[:size]


def _strings(codes: np.ndarray, clear: int) -> bytes:
    """What the codes between two clear codes stand for.

    Code number k adds to the table the string of number k - 1 and one byte more, which is a slice of the output from the
    place of number k - 1 on. So each byte is a copy of an earlier one, and both the lengths and the bytes come from
    following such references back, in steps that double."""
    n = len(codes)
    number = np.arange(n)
    literal = codes < clear
    entry = np.where(literal, number, codes - clear - 2)
    if ((entry >= number) & ~literal).any() or (codes > 4095).any():
        raise ValueError("a code that is not in the table")
    length, parent = (~literal).astype(np.int64), entry
    while not literal[parent].all():
        length = length + length[parent]
        parent = parent[parent]
    length = length + 1
    ends = np.cumsum(length)
    starts = ends - length
    total = int(ends[-1]) if n else 0
    source = np.arange(total) - np.repeat(starts - starts[entry], length)
    first = np.zeros(total, bool)
    first[starts[literal]] = True
    value = np.zeros(total, np.uint8)
    value[starts[literal]] = codes[literal]
    while not first[source].all():
        source = source[source]
    return value[source].tobytes()


@dataclass
class Frame:
    left: int
    top: int
    pixels: np.ndarray  # of the frame's own rectangle, rows x columns x RGB, after transparency
    canvas: np.ndarray  # of the whole screen while this frame shows
    delay_ms: int
    disposal: int
    transparent: int | None


def _blocks(data: bytes) -> bytes:
    """data as sub-blocks of at most 255 bytes, with the empty one at the end."""
    whole, rest = divmod(len(data), 255)
    out = np.empty((whole, 256), np.uint8)
    out[:, 0] = 255
    out[:, 1:] = np.frombuffer(data, np.uint8, whole * 255).reshape(whole, 255)
    return out.tobytes() + (bytes([rest]) + data[whole * 255 :] if rest else b"") + b"\0"


def encode(payload: bytes, width: int = WIDTH, rows: int = ROWS, delay: int = DELAY) -> bytes:
    """A grey GIF whose samples are the payload's bytes, whose length is a multiple of width; frames of at most `rows` rows."""
    parts = [payload[k : k + width * rows] for k in range(0, len(payload), width * rows)]
    out = [b"GIF89a", struct.pack("<HHBBB", width, min(rows, len(payload) // width), 0xF7, 0, 0), GREY]
    for part in parts:
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay, 0), b"\0\x2c", struct.pack("<HHHHB", 0, 0, width, len(part) // width, 0), b"\x08", _blocks(lzw_encode(part))]
    return b"".join([*out, b"\x3b"])


def decode(data: bytes) -> Iterator[Frame]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    try:
        yield from _frames(data)
    except (IndexError, struct.error) as e:
        raise ValueError("the file ends early") from e


def _frames(data: bytes) -> Iterator[Frame]:
    w, h, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at, palette = 13, None

    def colours(at: int, flags: int) -> np.ndarray:
        n = 2 << (flags & 7)
        if at + 3 * n > len(data):
            raise ValueError("the file ends early")
        return np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)

    def blocks(at: int) -> tuple[bytes, int]:
        out = []
        while n := data[at]:
            out.append(data[at + 1 : at + 1 + n])
            at += 1 + n
        return b"".join(out), at + 1

    if flags & 128:
        palette = colours(at, flags)
        at += 3 * len(palette)
    canvas = np.zeros((h, w, 3), np.uint8)
    delay, disposal, transparent = 0, 0, None
    while data[at] != 0x3B:
        if data[at] == 0x21:
            kind = data[at + 1]
            body, at = blocks(at + 2)
            if kind == 0xF9 and len(body) >= 4:
                control, hundredths, index = struct.unpack_from("<BHB", body)
                delay, disposal, transparent = 10 * hundredths, control >> 2 & 7, index if control & 1 else None
            continue
        if data[at] != 0x2C:
            raise ValueError("an unknown block")
        left, top, fw, fh, flags = struct.unpack_from("<HHHHB", data, at + 1)
        at += 10
        own = palette
        if flags & 128:
            own = colours(at, flags)
            at += 3 * len(own)
        if own is None:
            raise ValueError("a frame without a palette")
        bits = data[at]
        if not 1 <= bits <= 8:
            raise ValueError("a wrong code size")
        body, at = blocks(at + 1)
        index = np.frombuffer(lzw_decode(body, bits, fw * fh), np.uint8).reshape(fh, fw)
        if flags & 64:
            order = np.concatenate([np.arange(a, fh, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
            index = index[np.argsort(order)]
        if index.size and index.max() >= len(own) and (transparent is None or (index[index != transparent] >= len(own)).any()):
            raise ValueError("a colour that is not in the palette")
        if top + fh > h or left + fw > w:  # the screen grows, as viewers do
            bigger = np.zeros((max(h, top + fh), max(w, left + fw), 3), np.uint8)
            bigger[:h, :w] = canvas
            canvas, (h, w) = bigger, bigger.shape[:2]
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + fh, left : left + fw]
        shown = own[np.minimum(index, len(own) - 1)]
        if transparent is not None:
            shown = np.where((index == transparent)[:, :, None], area, shown)
        area[:] = shown
        yield Frame(left, top, shown, canvas.copy(), delay, disposal, transparent)
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            canvas = before
        delay, disposal, transparent = 0, 0, None


def histogram(pixels: np.ndarray) -> np.ndarray:
    """Pixels in each of 64 colours: four levels of red, green and blue."""
    p = pixels.reshape(-1, 3) >> 6
    return np.bincount((p[:, 0] << 4) | (p[:, 1] << 2) | p[:, 2], minlength=64)


def frames(df: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """A row for each frame of each GIF: id, frame, start_ms, delay_ms, its rectangle, disposal, transparent index, the canvas' colour histogram; error where it cannot be read."""
    kind = pa.schema([("id", pa.int64()), ("frame", pa.int32()), ("start_ms", pa.int64()), ("delay_ms", pa.int32()), *((x, pa.int32()) for x in ("left", "top", "width", "height", "disposal", "transparent")), ("histogram", pa.list_(pa.int64())), ("error", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, media in zip(b.column("id").to_pylist(), b.column("media").to_pylist(), strict=True):
                rows, start = [], 0
                try:
                    for k, f in enumerate(decode(media or b"")):
                        rows.append((doc, k, start, f.delay_ms, f.left, f.top, f.pixels.shape[1], f.pixels.shape[0], f.disposal, f.transparent, histogram(f.canvas).tolist(), None))
                        start += f.delay_ms
                except ValueError as e:
                    rows.append((doc, *[None] * 10, str(e)))
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], kind)

    return map_batches(
        df.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).cast("binary").alias("media")), read,
        "id bigint, frame int, start_ms bigint, delay_ms int, left int, top int, width int, height int, disposal int, transparent int, histogram array<bigint>, error string",
    )


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH or (0 if text else WIDTH))


def stored_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text as a GIF, reads that back and describes both; the media stay in the task."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text")), strict=True):
                media = encode(padded(text))
                got, seen, ms, n = [], np.zeros(64, np.int64), 0, 0
                for f in decode(media):
                    got.append(f.pixels[:, :, 0].tobytes())
                    seen += histogram(f.pixels)
                    ms, n = ms + f.delay_ms, n + 1
                payload = b"".join(got)
                rows.append((doc, len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), f"frames={n};ms={ms};grey=" + ",".join(map(str, seen[[0, 21, 42, 63]].tolist()))))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return map_batches(texts(docs, id_col, text_col), both, "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def op8_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_and_read(documents(spark, sf_dir))


PALETTE = ((0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255))


def animated(text: bytes, width: int = 16) -> bytes:
    """A text's bytes, two bits each, as three frames of four colours: all of them; the lower right half over it, where colour 3 is transparent, taken back after 70 ms; and the upper left half, cleared after 90 ms."""
    index = np.frombuffer(text or b"\0", np.uint8) & 3
    index = np.concatenate([index, np.zeros(-len(index) % width, np.uint8)]).reshape(-1, width)[:0xFFFF]
    h, half = len(index), width // 2
    low = max(1, h // 2)
    parts = [(0, 0, index, 5, 1, None), (half, h - low, index[:low, :half], 7, 3, 3), (0, 0, index[-low:, half:], 9, 2, None)]
    out = [b"GIF89a", struct.pack("<HHBBB", width, h, 0x81, 0, 0), bytes(c for p in PALETTE for c in p)]
    for x, y, pixels, delay, disposal, clear in parts:
        out += [b"\x21\xf9\x04", struct.pack("<BHB", disposal << 2 | (clear is not None), delay, clear or 0), b"\0\x2c", struct.pack("<HHHHB", x, y, pixels.shape[1], pixels.shape[0], 0), b"\x02", _blocks(lzw_encode(pixels.tobytes(), 2))]
    return b"".join(out) + b"\x3b"


def gif_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames of an animation for each page: palettes, disposal and transparency, and the colours of the canvas at each time."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array([animated(t) for t in as_bytes(b.column("html"))], pa.binary())], names=["page_id", "media"])

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("html"))
    return frames(map_batches(pages, make, "page_id bigint, media binary"), "page_id", "media").withColumnRenamed("id", "page_id")
