"""Media columns: baseline JPEG written, parsed and read back in numpy.

Writing: a payload byte is the mean of one 8x8 block, so it is the block's DC coefficient and nothing
is lost; 64 blocks stand in a row (more for long payloads) and every 64 blocks end with a restart
marker. The payload's length stands in a comment segment. Payloads over 32 MiB take several images,
one behind the other.

Reading: the markers of any baseline JPEG (grey or colour, with or without restarts, any sampling) are
parsed, the scan is Huffman-decoded, and the DC terms of the first component become a thumbnail with a
sample for every block. All restart segments of a batch are decoded side by side, a symbol a step in
each, so numpy works on thousands of segments at once.

The feature is the image's width and height, an average hash and a difference hash of the thumbnail.

Defined cases: a null text is the empty one (64 zero bytes); equal texts give equal media; rows repeat
as they stand; an empty table gives none; what is no baseline JPEG raises ``ValueError`` in ``read``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INTERVAL = 64
FRAME_BYTES = 32 << 20
MAX_BLOCKS = 65535 // 8
#: Payload bytes that are encoded and decoded together.
CHUNK = 1 << 20
#: Luminance DC table of the standard's annex K: codes of each length, then the values. Fixed values.
DC_BITS, DC_VALUES = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0), tuple(range(12))
#: The only AC symbol that is written is "end of block", as a single zero bit.
AC_BITS, AC_VALUES = (1, *[0] * 15), (0,)


def _codes(bits: tuple[int, ...], values: tuple[int, ...]) -> dict[int, tuple[int, int]]:
    """Canonical Huffman codes: symbol to (code, length)."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(bits, 1):
        for symbol in values[at : at + n]:
            out[symbol] = (code, length)
            code += 1
        code, at = code << 1, at + n
    return out


_LOOKUPS: dict[tuple, np.ndarray] = {}


def _lookup(bits: tuple[int, ...], values: tuple[int, ...]) -> np.ndarray:
    """16 peeked bits to 256 * code length + symbol; 0 where no code matches."""
    if (bits, values) not in _LOOKUPS:
        table = np.zeros(1 << 16, np.int32)
        for symbol, (code, length) in _codes(bits, values).items():
            table[code << (16 - length) : (code + 1) << (16 - length)] = 256 * length + symbol
        if len(_LOOKUPS) > 64:
            _LOOKUPS.clear()
        _LOOKUPS[bits, values] = table
    return _LOOKUPS[bits, values]


_DC_CODES = _codes(DC_BITS, DC_VALUES)
_DC_CODE = np.array([_DC_CODES[c][0] for c in range(12)])
_DC_LENGTH = np.array([_DC_CODES[c][1] for c in range(12)])
_CATEGORY = np.array([int(x).bit_length() for x in range(256)])


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _shape(size: int) -> tuple[int, int]:
    """Blocks across and down for a payload of ``size`` bytes."""
    across = INTERVAL * -(-size // (INTERVAL * MAX_BLOCKS))
    return across, -(-size // across)


def _header(size: int) -> bytes:
    across, down = _shape(size)
    return b"".join((
        b"\xff\xd8",
        _segment(0xFE, b"payload " + str(size).encode()),
        _segment(0xDB, b"\0" + bytes([8] + [1] * 63)),
        _segment(0xC0, struct.pack(">BHHB3B", 8, 8 * down, 8 * across, 1, 1, 0x11, 0)),
        _segment(0xC4, b"\x00" + bytes(DC_BITS) + bytes(DC_VALUES)),
        _segment(0xC4, b"\x10" + bytes(AC_BITS) + bytes(AC_VALUES)),
        _segment(0xDD, struct.pack(">H", INTERVAL)),
        _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
    ))


def _scans(samples: np.ndarray, firsts: np.ndarray) -> list[bytes]:
    """The entropy-coded scans of several images; ``samples`` has 64 a row, ``firsts`` each image's first row."""
    level = samples.astype(np.int64) - 128
    diff = np.diff(level, axis=1, prepend=0)
    category = _CATEGORY[np.abs(diff)]
    amplitude = np.where(diff < 0, diff + (1 << category) - 1, diff)
    length = _DC_LENGTH[category] + category + 1
    code = (_DC_CODE[category] << category | amplitude) << 1
    ends = np.cumsum(length, axis=1)
    used = (ends[:, -1] + 7) >> 3
    begin = np.concatenate(([0], np.cumsum(used)))
    at = (8 * begin[:-1, None] + ends - length).ravel()
    window = code.ravel() << (24 - (at & 7) - length.ravel())
    byte, total = at >> 3, int(begin[-1])
    out = sum(np.bincount(byte + i, (window >> (16 - 8 * i)) & 255, total + 2)[:total] for i in range(3)).astype(np.int64)
    out[begin[1:] - 1] += (1 << (8 * used - ends[:, -1])) - 1
    # A zero byte behind every 0xFF, and a restart marker between the segments of an image.
    row = np.repeat(np.arange(len(samples)), used)
    place = np.arange(total) + np.cumsum(np.concatenate(([0], out[:-1] == 255))) + 2 * row
    full = np.zeros(total + int((out == 255).sum()) + 2 * len(samples), np.uint8)
    full[place] = out
    number = np.arange(len(samples)) - np.repeat(firsts, np.diff(np.append(firsts, len(samples))))
    mark = place[begin[1:] - 1] + 1 + (out[begin[1:] - 1] == 255)
    full[mark], full[mark + 1] = 0xFF, 0xD0 + number % 8
    cut = np.append(np.concatenate(([0], mark + 2))[firsts], len(full)).tolist()
    return [full[a : z - 2].tobytes() for a, z in zip(cut, cut[1:])]


def write(payloads: list[bytes]) -> list[bytes]:
    """A JPEG stream for each payload; every length must be a positive multiple of 64."""
    frames, owner = [], []
    for i, p in enumerate(payloads):
        if not p or len(p) % INTERVAL:
            raise ValueError("a payload has a positive multiple of 64 bytes")
        parts = [p[a : a + FRAME_BYTES] for a in range(0, len(p), FRAME_BYTES)]
        frames += parts
        owner += [i] * len(parts)
    padded = []
    for p in frames:
        across, down = _shape(len(p))
        padded.append(p + bytes(across * down - len(p)))
    rows = np.array([len(p) // INTERVAL for p in padded])
    samples = np.frombuffer(b"".join(padded), np.uint8).reshape(-1, INTERVAL)
    scans = _scans(samples, np.concatenate(([0], np.cumsum(rows)[:-1])).astype(np.int64)) if padded else []
    out = [b""] * len(payloads)
    for i, p, scan in zip(owner, frames, scans):
        out[i] += _header(len(p)) + scan + b"\xff\xd9"
    return out


@dataclass
class Frame:
    """A parsed baseline JPEG; ``luma`` is the DC-only thumbnail of the first component."""

    width: int = 0
    height: int = 0
    comment: bytes = b""
    quant: dict[int, int] = field(default_factory=dict)
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, across, down, quant table
    tables: dict[int, np.ndarray] = field(default_factory=dict)
    interval: int = 0
    scan: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)  # component index, DC and AC lookup
    entropy: tuple[int, int] = (0, 0)
    luma: np.ndarray | None = None


def _parse(data: bytes, at: int) -> tuple[Frame, int]:
    """The frame that starts at ``at``, and where its scan's entropy-coded data starts."""
    frame = Frame()
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no JPEG starts here")
    at += 2
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker = data[at + 1]
        if marker == 0xFF:  # a fill byte
            at += 1
            continue
        (size,) = struct.unpack_from(">H", data, at + 2)
        body = data[at + 4 : at + 2 + size]
        if len(body) != size - 2:
            raise ValueError("a segment is cut off")
        at += 2 + size
        if marker == 0xFE:
            frame.comment = body
        elif marker == 0xDB:
            i = 0
            while i < len(body):
                wide, name = body[i] >> 4, body[i] & 15
                frame.quant[name] = int.from_bytes(body[i + 1 : i + 2 + wide], "big")
                i += 1 + 64 * (1 + wide)
        elif marker == 0xC0:
            precision, frame.height, frame.width, n = struct.unpack_from(">BHHB", body)
            if precision != 8:
                raise ValueError("baseline samples have 8 bits")
            frame.components = [(body[6 + 3 * c], body[7 + 3 * c] >> 4, body[7 + 3 * c] & 15, body[8 + 3 * c]) for c in range(n)]
        elif marker == 0xC4:
            i = 0
            while i < len(body):
                bits = tuple(body[i + 1 : i + 17])
                frame.tables[body[i]] = _lookup(bits, tuple(body[i + 17 : i + 17 + sum(bits)]))
                i += 17 + sum(bits)
        elif marker == 0xDD:
            (frame.interval,) = struct.unpack(">H", body)
        elif marker == 0xDA:
            known = {c[0]: i for i, c in enumerate(frame.components)}
            for s in range(body[0]):
                name, use = body[1 + 2 * s], body[2 + 2 * s]
                frame.scan.append((known[name], frame.tables[use >> 4], frame.tables[16 + (use & 15)]))
            return frame, at
        elif 0xC1 <= marker <= 0xCF:
            raise ValueError("only baseline JPEG is read")


def _entropy(data: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Scan bytes without stuffing, where each restart segment starts in them, and the next marker."""
    marks = np.flatnonzero(data[at:-1] == 0xFF) + at
    after = data[marks + 1]
    stop = np.flatnonzero((after != 0) & (after != 0xFF) & ((after < 0xD0) | (after > 0xD7)))
    end = int(marks[stop[0]]) if len(stop) else len(data)
    marks, after = marks[marks < end], after[marks < end]
    keep = np.ones(end - at, bool)
    keep[marks[after == 0] + 1 - at] = False
    restart = marks[(after >= 0xD0) & (after <= 0xD7)]
    for gone in (restart, restart + 1, marks[after == 0xFF]):
        keep[gone - at] = False
    starts = np.concatenate(([0], np.cumsum(keep)[restart - at])) if len(restart) else np.zeros(1, np.int64)
    return data[at:end][keep], starts.astype(np.int64), end


def _layout(frame: Frame) -> tuple[list[int], int, int]:
    """Scan entry of each block of an MCU, and MCUs across and down."""
    if len(frame.scan) == 1:
        _, h, v, _ = frame.components[frame.scan[0][0]]
        most_h, most_v = (max(c[i] for c in frame.components) for i in (1, 2))
        return [0], -(-frame.width * h // (8 * most_h)), -(-frame.height * v // (8 * most_v))
    most_h, most_v = (max(frame.components[s[0]][i] for s in frame.scan) for i in (1, 2))
    slots = [i for i, s in enumerate(frame.scan) for _ in range(frame.components[s[0]][1] * frame.components[s[0]][2])]
    return slots, -(-frame.width // (8 * most_h)), -(-frame.height // (8 * most_v))


def read(streams: list[bytes]) -> list[list[Frame]]:
    """The frames of each stream with their thumbnails; all segments of all frames are decoded side by side."""
    out: list[list[Frame]] = []
    jobs = []
    for stream in streams:
        frames, at, data = [], 0, np.frombuffer(stream, np.uint8)
        while at < len(stream):
            frame, at = _parse(stream, at)
            body, starts, at = _entropy(data, at)
            if stream[at : at + 2] != b"\xff\xd9":
                raise ValueError("only single-scan baseline JPEG is read")
            at += 2
            frames.append(frame)
            jobs.append((frame, body, starts))
        out.append(frames)
    if jobs:
        _decode(jobs)
    return out


def _decode(jobs: list[tuple[Frame, np.ndarray, np.ndarray]]) -> None:
    lookups: dict[int, int] = {}
    stack: list[np.ndarray] = []

    def known(table: np.ndarray) -> int:
        if id(table) not in lookups:
            lookups[id(table)] = len(stack)
            stack.append(table)
        return lookups[id(table)]

    layouts = [_layout(f) for f, _, _ in jobs]
    width = max(len(slots) for slots, _, _ in layouts)
    dc_of, ac_of = np.zeros((len(jobs), width), np.int64), np.zeros((len(jobs), width), np.int64)
    owner, first_bit, first_block, blocks = [], [], [], []
    base = bits = 0
    for j, ((frame, body, starts), (slots, across, down)) in enumerate(zip(jobs, layouts)):
        for s, entry in enumerate(slots):
            dc_of[j, s], ac_of[j, s] = known(frame.scan[entry][1]), known(frame.scan[entry][2])
        total = across * down * len(slots)
        each = frame.interval * len(slots) if frame.interval else total
        n = max(1, -(-total // each))
        if n != len(starts):
            raise ValueError("restart markers are missing")
        low = np.arange(n) * each
        owner.append(np.full(n, j))
        first_bit.append(8 * (bits + starts))
        first_block.append(base + low)
        blocks.append(np.minimum(each, total - low))
        bits, base = bits + len(body), base + total
    joined = np.concatenate([b for _, b, _ in jobs] + [np.zeros(8, np.uint8)]).astype(np.int32)
    window = joined[:-2] << 16 | joined[1:-1] << 8 | joined[2:]
    table = np.concatenate(stack)
    found = _symbols(window, table, np.concatenate(owner), np.concatenate(first_bit), np.concatenate(first_block), np.concatenate(blocks), dc_of << 16, ac_of << 16, np.array([len(s) for s, _, _ in layouts]), base, [c for c in layouts], jobs)
    at = 0
    for (frame, _, _), (slots, across, down) in zip(jobs, layouts):
        n = across * down * len(slots)
        index, h, v, q = *frame.scan[0][:1], *frame.components[frame.scan[0][0]][1:]
        if len(slots) == 1:
            h = v = 1
        luma = found[at : at + n].reshape(down, across, len(slots))[:, :, : h * v].reshape(down, across, v, h).swapaxes(1, 2).reshape(down * v, across * h)
        frame.luma = np.clip(np.rint(luma * frame.quant[q] / 8) + 128, 0, 255).astype(np.uint8)
        at += n


def _symbols(window, table, owner, bit, block, left, dc_of, ac_of, slots, total, layouts, jobs) -> np.ndarray:
    """DC coefficients of all blocks; each step reads one symbol in every segment that is not at its end."""
    entry_of = np.zeros(dc_of.shape, np.int64)
    for j, (s, _, _) in enumerate(layouts):
        entry_of[j, : len(s)] = s
    found = np.zeros(total, np.int64)
    last = np.zeros((len(owner), int(entry_of.max()) + 1), np.int64)
    segment, slot, k = np.arange(len(owner)), np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
    most = len(window) - 1
    while len(segment):
        own = owner[segment]
        is_dc = k == 0
        which = np.where(is_dc, dc_of[own, slot], ac_of[own, slot])
        hit = table[which + ((window[np.minimum(bit >> 3, most)] >> (8 - (bit & 7))) & 0xFFFF)]
        if not hit.all():
            raise ValueError("a Huffman code is not in its table")
        bit = bit + (hit >> 8)
        symbol = hit & 255
        size = np.where(is_dc, symbol, symbol & 15)
        if is_dc.any():
            d = np.flatnonzero(is_dc)
            s = size[d]
            raw = ((window[np.minimum(bit[d] >> 3, most)] >> (8 - (bit[d] & 7))) & 0xFFFF) >> (16 - s)
            diff = np.where((s > 0) & (raw < 1 << np.maximum(s - 1, 0)), raw - (1 << s) + 1, raw)
            at = (segment[d], entry_of[own[d], slot[d]])
            last[at] += diff
            found[block[d]] = last[at]
        bit = bit + size
        run = symbol >> 4
        k = np.where(is_dc, 1, np.where(size > 0, k + run + 1, np.where(run == 15, k + 16, 64)))
        done = k >= 64
        if done.any():
            k = np.where(done, 0, k)
            block, left = block + done, left - done
            slot = np.where(done, (slot + 1) % slots[own], slot)
            if not left.all():
                on = left > 0
                segment, slot, k, bit, block, left = segment[on], slot[on], k[on], bit[on], block[on], left[on]
    return found


def payload(frames: list[Frame]) -> bytes:
    """The bytes that ``write`` stored."""
    out = []
    for f in frames:
        if not f.comment.startswith(b"payload "):
            raise ValueError("no payload is stored here")
        out.append(f.luma.tobytes()[: int(f.comment[8:])])
    return b"".join(out)


def _resized(thumb: np.ndarray, down: int, across: int) -> np.ndarray:
    """Means over an even grid; a cell is at least one sample."""
    sums = np.zeros((thumb.shape[0] + 1, thumb.shape[1] + 1))
    sums[1:, 1:] = thumb.cumsum(0, dtype=np.float64).cumsum(1)
    a, z = (np.arange(down) * thumb.shape[0] // down), -(-np.arange(1, down + 1) * thumb.shape[0] // down)
    b, y = (np.arange(across) * thumb.shape[1] // across), -(-np.arange(1, across + 1) * thumb.shape[1] // across)
    area = (z - a)[:, None] * (y - b)[None, :]
    return (sums[np.ix_(z, y)] - sums[np.ix_(a, y)] - sums[np.ix_(z, b)] + sums[np.ix_(a, b)]) / area


def feature(frames: list[Frame]) -> str:
    """``WIDTHxHEIGHT:average hash:difference hash`` of each frame's thumbnail, frames joined by commas."""
    out = []
    for f in frames:
        small, wide = _resized(f.luma, 8, 8), _resized(f.luma, 8, 9)
        average = np.packbits(small > small.mean()).tobytes().hex()
        steps = np.packbits(wide[:, 1:] > wide[:, :-1]).tobytes().hex()
        out.append(f"{f.width}x{f.height}:{average}:{steps}")
    return ",".join(out)


def padded(text: str | None) -> tuple[int, bytes]:
    """UTF-8 length of a text, and its bytes with zeros up to a positive multiple of 64."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(data), data + bytes(-len(data) % 64 if data else 64)


def _chunks(texts: list) -> Iterator[tuple[list[int], list[bytes]]]:
    sizes, payloads, used = [], [], 0
    for t in texts:
        n, p = padded(t)
        sizes.append(n)
        payloads.append(p)
        used += len(p)
        if used >= CHUNK:
            yield sizes, payloads
            sizes, payloads, used = [], [], 0
    if payloads:
        yield sizes, payloads


def store(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media``: every whole text as a JPEG stream."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for sizes, payloads in _chunks(batch.column(1).to_pylist()):
                ids = batch.column(0).slice(at, len(sizes))
                at += len(sizes)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(write(payloads), pa.binary())], ["doc_id", "n_bytes", "media"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def digests(media: DataFrame) -> DataFrame:
    """What ``store`` wrote, read back: payload and media checksums, dimensions and thumbnail hashes."""
    kind = media.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            streams = batch.column(2).to_pylist()
            rows, held, used = [], [], 0
            for stream in streams:
                held.append(stream)
                used += len(stream)
                if used >= CHUNK:
                    rows += [(payload(f), feature(f)) for f in read(held)]
                    held, used = [], 0
            rows += [(payload(f), feature(f)) for f in read(held)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                batch.column(1),
                pa.array([len(p) for p, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p, _ in rows], pa.string()),
                pa.array([zlib.crc32(p[-64:]) for p, _ in rows], pa.int64()),
                pa.array([len(m) for m in streams], pa.int64()),
                pa.array([hashlib.sha256(m).hexdigest() for m in streams], pa.string()),
                pa.array([f for _, f in rows], pa.string()),
            ], schema.replace(f" {kind}", "", 1).replace(" long", "").replace(" string", "").split(", "))

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)
