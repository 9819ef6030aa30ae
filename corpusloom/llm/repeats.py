"""Byte strings that repeat, by threshold-bounded interval expansion on Burrows-Wheeler transforms.

A byte goes if some string of ``width`` bytes over it also starts anywhere else. The windows (strings of ``width`` bytes) of a text are dealt by their
minimizer, the least hash of their grams of ``GRAM`` bytes: equal windows have equal minimizers, and
neighbours share theirs, so a run of windows travels as one chunk of bytes. Minimizers that stand at one
place only are dropped first, by counts of hashes, so only what may repeat is shipped, and a task ships equal
chunks once, with a weight. Texts are named by their MD5.

A task takes whole minimizer groups up to some MB, sorts their suffixes by ``width`` bytes and forms the
Burrows-Wheeler transform. From the intervals of all strings of eight bytes, which the sort gives, it extends
intervals backwards, breadth first: the interval of a string of n bytes becomes those of the strings of n + 1 bytes that end with it.
An interval that ends at a boundary seen first marks it: its neighbours share n bytes and no more, so
common prefixes are derived by increasing value, each boundary once, and the search stops at ``width``
bytes. Suffixes with no marked boundary between them share ``width`` bytes or more: they are the repeats.

A minimizer with over ``HOT`` places is dealt by eight windows at a time and the ``width - 7`` bytes
that those have in common; a group that is still larger than ``GROUP_BYTES`` is settled window by window, by
equality. So no group is unbounded, and none is dropped. Hash collisions join groups and never lose or
invent a repeat.

Defined cases: a null text is empty; a text shorter than ``width`` keeps all; overlapping repeats in one
text count; equal texts of ``width`` bytes or more lose everything; repeated rows are equal texts; ids,
null or not, are only handed on; other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import shared_folder, spread

from .common import durable, join_frequent, remove_folder

#: Bytes of a gram, of texts that are hashed together, of chunks in one transform, and of one group at most.
GRAM, BLOCK, CHUNKS, GROUP_BYTES = 64, 1 << 19, 1 << 19, 900_000
#: Places from which a minimizer is dealt by ``STEP`` windows at a time; bits of the bitmaps of minimizers and texts.
HOT, STEP, BITMAP_BITS = 1 << 11, 8, 26
#: Repeated minimizers up to which the bitmap alone tells them well enough; beyond, they are joined. What else the bitmap lets by
#: is alone in its group and falls there, so the result is the same.
SPARSE = 1 << (BITMAP_BITS - 3)
#: Bytes of distinct chunks that a task holds back to send each once; rows that are turned into Python values together.
HELD, ROWS = 1 << 22, 128
_ODD, _SEPARATOR = 0x9E3779B97F4A7C15, 0xFF  # no byte of UTF-8 is 0xFF


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, modulo 2**64."""
    out = []
    for base in (_ODD, pow(_ODD, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class _Grams:
    """Hashes of all grams of a block, from prefix sums; the tables grow to the longest block."""

    def __init__(self):
        self.up, self.down = _powers(1 << 10)

    def __call__(self, block: np.ndarray, gram: int) -> np.ndarray:
        if len(block) > len(self.up):
            self.up, self.down = _powers(len(block) + BLOCK)
        sums = np.concatenate(([np.uint64(0)], np.cumsum((block.astype(np.uint64) + np.uint64(1)) * self.up[: len(block)])))
        h = (sums[gram:] - sums[:-gram]) * self.down[: len(block) - gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


_grams = _Grams()


def minimizers(block: np.ndarray, ends: np.ndarray, width: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first window, last window, place of the minimizer, its hash) of the runs of windows that share one.

    ``block`` holds texts one behind the other that end at ``ends``; no window crosses an end.
    """
    n = len(block) - width + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    h = _grams(block, gram)
    low = np.uint64((1 << 24) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the leftmost
    grams, step = width - gram + 1, 1
    while 2 * step <= grams:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if rest := grams - step:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & low).astype(np.int64)
    start = np.arange(n)
    text = np.searchsorted(ends, start, "right")
    whole = start + width <= ends[np.minimum(text, len(ends) - 1)]
    fresh = np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]))
    first = np.flatnonzero(fresh & whole)
    stops = np.flatnonzero(whole & np.concatenate((fresh[1:] | ~whole[1:], [True])))
    return first, stops, at[first], h[at[first]]


def _heads(s: np.ndarray, n: int) -> np.ndarray:
    """The next ``n`` (at most eight) bytes of each place as a number; behind the end stand separators."""
    padded = np.concatenate([s, np.full(8, _SEPARATOR, np.uint8)])
    key = np.zeros(len(s), np.uint64)
    for i in range(n):
        key = (key << np.uint64(8)) | padded[i : i + len(s)]
    return key


def suffix_order(s: np.ndarray, width: int) -> np.ndarray:
    """Positions of ``s`` in the order of their next ``width`` bytes."""
    done = min(8, width)
    padded = np.concatenate([s, np.full(width, _SEPARATOR, np.uint8)])
    key = _heads(padded, done)
    bits = max(21, len(padded).bit_length())  # of a rank; three ranks make a key where they fit
    while True:
        order = np.argsort(key)
        if done == width:
            return order[order < len(s)]
        key = key[order]
        fresh = np.empty(len(key), np.uint64)
        fresh[0] = 0
        np.cumsum(key[1:] != key[:-1], out=fresh[1:])
        rank = key  # its memory serves again
        rank[order] = fresh
        key, known = fresh, done
        key[:] = rank
        for _ in range(64 // bits - 1):
            step = min(done, width - known)
            if step:
                key <<= np.uint64(bits)
                key[: len(key) - known - step + done] |= rank[known + step - done :]
                known += step
        done = known


def common_prefix_boundaries(s: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """For each place in ``order``, whether its suffix shares under ``width`` bytes with the one before."""
    n = len(s)
    before = s[order - 1]  # the transform; the first suffix is preceded by the last byte
    by_byte = np.argsort(before, kind="stable")
    step_back = np.empty(n, np.int32)  # places of one transform fit four bytes
    step_back[by_byte] = np.arange(n, dtype=np.int32)
    del by_byte
    known = min(8, width)
    heads = _heads(s, known)[order]
    low = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1]))).astype(np.int32)
    del heads
    high = np.append(low[1:], np.int32(n))
    marked = np.zeros(n + 1, bool)
    marked[low] = marked[n] = True
    edges = np.flatnonzero(before[1:] != before[:-1]) + 1
    stops = np.append(edges, n).astype(np.int32)
    run_end = np.repeat(stops, np.diff(stops, prepend=0))  # of equal preceding bytes
    owner = np.empty(n, np.int32)
    for _ in range(known, width):
        plain = run_end[low] >= high  # one byte precedes the whole interval
        new_low = [step_back[low[plain]]]
        new_high = [new_low[0] + (high - low)[plain]]
        a, z = low[~plain], high[~plain]
        if len(a):
            size = z - a
            ends = np.cumsum(size)
            number = np.repeat(np.arange(len(a), dtype=np.int32), size)
            to = step_back[np.repeat((a - (ends - size)).astype(np.int32), size) + np.arange(ends[-1], dtype=np.int32)]
            owner[to] = number
            to.sort()
            mine, byte = owner[to], s[order[to]]
            fresh = np.concatenate(([True], (to[1:] != to[:-1] + 1) | (mine[1:] != mine[:-1]) | (byte[1:] != byte[:-1])))
            new_low.append(to[fresh])
            new_high.append(to[np.concatenate((fresh[1:], [True]))] + 1)
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        unseen = ~marked[high]
        low, high = low[unseen], high[unseen]
        if not len(low):
            break
        marked[high] = True
    return marked[:n]


def repeated_windows(chunks: list[bytes], weights: list[int], width: int) -> list[list[tuple[int, int]]]:
    """For each chunk the runs (first, last) of its windows that stand at two places or more."""
    sizes = np.array([len(c) + 1 for c in chunks])
    s = np.frombuffer(b"".join(c + bytes([_SEPARATOR]) for c in chunks), np.uint8)
    order = suffix_order(s, width).astype(np.int32)
    group = np.cumsum(common_prefix_boundaries(s, order, width)) - 1
    chunk = np.repeat(np.arange(len(chunks)), sizes)
    starts = np.cumsum(sizes) - sizes
    inside = np.arange(len(s)) - starts[chunk] <= (sizes - 1 - width)[chunk]
    weight = np.where(inside, np.array(weights)[chunk], 0)
    found = np.zeros(len(s) + 1, bool)
    found[order] = np.bincount(group, weight[order])[group] > 1
    found[:-1] &= inside
    edge = np.flatnonzero(np.diff(np.concatenate(([False], found)).astype(np.int8)))
    out: list[list[tuple[int, int]]] = [[] for _ in chunks]
    for a, z in edge.reshape(-1, 2).tolist():  # a chunk's last place is its separator, so runs end inside
        i = int(chunk[a])
        out[i].append((a - int(starts[i]), z - 1 - int(starts[i])))
    return out


def _blocks(rows: Iterator[tuple[int, bytes]], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, row numbers, offsets in the text) of pieces put together; long texts come in pieces that overlap."""
    held, size = [], 0
    for number, text in rows:
        for at in range(0, max(1, len(text) - width + 1), BLOCK):
            piece = text[at : at + BLOCK + width - 1]
            if len(piece) >= width:
                held.append((number, at, piece))
                size += len(piece)
            if size >= BLOCK:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    number, at, pieces = zip(*held)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([len(p) for p in pieces]), np.array(number), np.array(at)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def _list_minimizers(width: int):
    """``keys, marks``: the minimizers of some texts, and packed beside them text, first and last window and place of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("h")
            texts = (t.as_py() for t in batch.column("text"))
            for block, ends, number, offset in _blocks(enumerate(texts), width):
                first, last, at, key = minimizers(block, ends, width)
                if not len(key):
                    continue
                piece = np.searchsorted(ends, first, "right")
                shift = offset[piece] - np.concatenate(([0], ends[:-1]))[piece]
                used, text = np.unique(number[piece], return_inverse=True)
                names = b"".join(hashes.take(pa.array(used)).to_pylist())
                marks = np.column_stack([text, first + shift, last - first, at - first]).astype(np.int64).tobytes()
                columns = [[key.tobytes()], [zstandard.compress(marks, 1)], [names]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["keys", "marks", "names"])

    return run


def _count_minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(0):
            keys, n = np.unique(np.frombuffer(packed.as_py(), np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(keys), pa.array(n)], ["key", "n"])


def _marked(keys: DataFrame) -> np.ndarray:
    """A bitmap with the last ``BITMAP_BITS`` bits of every ``key``."""
    word = F.shiftright(F.col("key").bitwiseAND((1 << BITMAP_BITS) - 1), 6).alias("w")
    found = keys.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("b")).toArrow()  # 1 << (BITMAP_BITS - 6) rows at most
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out


_MARK = "h binary, first long, last long, at long, key long"


def _repeated_marks(shared):
    """Runs of windows whose minimizer may repeat: the bitmap lets all repeated ones by, and a few more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for packed, marks, names in zip(*batch.columns):
                key = np.frombuffer(packed.as_py(), np.uint64)
                low = (key & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
                some = (bits[low >> 6] >> (low & 63)) & 1 == 1
                text, first, long, at = np.frombuffer(zstandard.decompress(marks.as_py()), np.int64).reshape(-1, 4)[some].T
                names = names.as_py()
                own = pa.array([names[i : i + 16] for i in range(0, len(names), 16)], pa.binary()).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([own, pa.array(first), pa.array(first + long), pa.array(first + at), _signed(key[some])], ["h", "first", "last", "at", "key"])

    return run


_MARKS = "array<struct<first:bigint,last:bigint,at:bigint,key:bigint,hot:boolean>>"


def _grouped_marks(shared):
    """The marks of each piece of a text as one list; minimizers that may repeat and that may be hot are told by bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, hot = shared.value
        for batch in batches:
            for packed, marks, names in zip(*batch.columns):
                key = np.frombuffer(packed.as_py(), np.uint64)
                low = (key & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
                some = (repeated[low >> 6] >> (low & 63)) & 1 == 1
                text, first, long, at = np.frombuffer(zstandard.decompress(marks.as_py()), np.int64).reshape(-1, 4)[some].T
                if not len(text):
                    continue
                low = low[some]
                starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                columns = [pa.array(first), pa.array(first + long), pa.array(first + at), _signed(key[some]), pa.array((hot[low >> 6] >> (low & 63)) & 1 == 1)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(text)), pa.int32()), pa.StructArray.from_arrays(columns, ["first", "last", "at", "key", "hot"]))
                names = names.as_py()
                own = [names[16 * i : 16 * i + 16] for i in text[starts].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), lists], ["h", "marks"])

    return run


_CHUNK = "h binary, start long, cid binary, key long, chunk binary, m int"


def _pieces(text: bytes, first: int, last: int, at: int, key: int, hot: bool, width: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, key, bytes) of a marked run; a hot minimizer's is cut by ``STEP`` windows and dealt by what those share."""
    if not hot:
        yield first, key, text[first : last + width]
        return
    for j in range((at - last) // STEP, (at - first) // STEP + 1):
        a, z = max(first, at - STEP * j - STEP + 1), min(last, at - STEP * j)
        core = text[at - STEP * j : at - STEP * j - STEP + 1 + width]
        digest = hashlib.blake2b(core, digest_size=8, key=j.to_bytes(4, "little")).digest()
        yield a, int.from_bytes(digest, "little", signed=True), text[a : z + width]


def _cut_chunks(width: int):
    """A row for each chunk's place (``h, start, cid``), and one for its bytes (``cid, key, chunk, m``) as often as the task has to let go of them."""

    def table(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["h", "start", "cid", "key", "chunk", "m"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for batch in _slices(batches):
            places = []
            lists = batch.column("marks")
            fields = [f.to_pylist() for f in lists.flatten().flatten()]
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).tolist()
            for i, (h, text) in enumerate(zip(batch.column("h").to_pylist(), batch.column("text").to_pylist())):
                for mark in dict.fromkeys(zip(*(f[ends[i] : ends[i + 1]] for f in fields))):
                    for start, key, chunk in _pieces(text, *mark, width):
                        cid = hashlib.md5(chunk).digest()
                        places.append((h, start, cid, None, None, None))
                        if cid in held:
                            held[cid][2] = 2  # twice is as good as often
                        else:
                            held[cid] = [key, chunk, 1]
                            size += len(chunk)
                if size > HELD:
                    yield table([(None, None, c, *row) for c, row in held.items()])
                    held, size = {}, 0
            if places:
                yield table(places)
        if held:
            yield table([(None, None, c, *row) for c, row in held.items()])

    return run


_FOUND = "cid binary, first array<int>, last array<int>, chunk binary, m int"


def _transform(width: int, enough: int, most: int):
    """``key, cid, chunk, m`` rows sorted by key and cid to the repeated windows of each chunk; a group beyond bounds is handed on as it is."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["cid", "first", "last", "chunk", "m"])

    def settle(rows: list[list]) -> Iterator[pa.RecordBatch]:
        found = repeated_windows([c for _, c, _ in rows], [m for *_, m in rows], width)
        hits = [(cid, [a for a, _ in f], [z for _, z in f], None, None) for (cid, *_), f in zip(rows, found) if f]
        if hits:
            yield out(hits)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[list], bool]]:
        """(distinct chunks of one key with their weights, whether they are only a part of it)."""
        group: list[list] = []
        size, last, over = 0, None, False
        for batch in _slices(batches):
            for key, cid, chunk, m in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last:
                    if group:
                        yield group, over
                    group, size, last, over = [], 0, key, False
                if group and group[-1][0] == cid:
                    group[-1][2] += m
                    continue
                if size > most:
                    over = True
                    yield group, over
                    group, size = [], 0
                group.append([cid, chunk, m])
                size += len(chunk)
        if group:
            yield group, over

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size = [], 0
        for group, part in groups(batches):
            own = sum(len(c) for _, c, _ in group)
            if size and size + own > enough:
                yield from settle(ready)
                ready, size = [], 0
            if part:
                yield out([(cid, None, None, chunk, m) for cid, chunk, m in group])
            elif len(group) > 1:
                ready += group
                size += own
            elif group[0][2] > 1:  # alone in its group and at two places: all its windows are
                yield out([(group[0][0], [0], [len(group[0][1]) - width], None, None)])
            if size >= enough:
                yield from settle(ready)
                ready, size = [], 0
        if ready:
            yield from settle(ready)

    return run


def _window_by_window(todo: DataFrame, width: int) -> DataFrame:
    """``cid, first, last`` of the windows of oversized groups, compared by equality."""
    windows = todo.select("cid", "m", F.posexplode(F.expr(f"transform(sequence(1, length(chunk) - {width - 1}), i -> md5(substring(chunk, i, {width})))")).alias("i", "w"))
    often = windows.groupBy("w").agg(F.sum("m").alias("n")).where("n > 1").select("w")
    hits = windows.join(often, "w", "left_semi").select("cid", F.col("i").alias("i"))
    return hits.groupBy("cid").agg(F.array_sort(F.collect_set("i")).alias("first")).select("cid", "first", F.col("first").alias("last"))


def _finish(width: int, outputs: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for h, text, hits in zip(*(batch.column(c).to_pylist() for c in ("h", "text", "hits"))):
                spans: list[list[int]] = []
                for a, z in sorted((x["a"], x["z"]) for x in hits):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], z + width)
                    else:
                        spans.append([a, z + width])
                edges = [0, *(x for s in spans for x in s), len(text)]
                kept = b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2]))
                made = {"n_removed": len(text) - len(kept), "n_spans": len(spans), "kept": kept, "spans": [{"start": a, "end": z} for a, z in spans]}
                made["kept_sha256"] = hashlib.sha256(kept).hexdigest()
                rows.append((h, *(made[o] for o in outputs)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.binary(), *(_ARROW[o] for o in outputs)])], ["h", *outputs])

    return run


_TYPES = {"n_removed": "long", "n_spans": "long", "kept_sha256": "string", "kept": "binary", "spans": "array<struct<start:bigint,end:bigint>>"}
_ARROW = {"n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}


def _whole(name: str) -> Column:
    """An output of a text without repeats."""
    value = {"kept_sha256": lambda: F.sha2("text", 256), "kept": lambda: F.col("text"), "spans": lambda: F.array()}.get(name, lambda: F.lit(0))()
    return value.cast(_TYPES[name]).alias(name)


def _only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` (``h, text``) without most of those whose ``h`` is not ``wanted``: a bitmap keeps their texts out of the shuffle."""
    bits_of = F.xxhash64("h").alias("key")
    shared = rows.sparkSession.sparkContext.broadcast(_marked(wanted.select(bits_of)))  # 1 << BITMAP_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            low = batch.column(2).to_numpy() & ((1 << BITMAP_BITS) - 1)
            yield batch.filter(pa.array((bits[low >> 6] >> (low & 63)) & 1 == 1)).select(["h", "text"])

    return rows.select("h", "text", bits_of).mapInArrow(run, "h binary, text binary")


def _written(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` as a compressed table in the shared folder."""
    rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _hits(texts: DataFrame, names: DataFrame, width: int, folder: str) -> DataFrame:
    """``h, hits``: first and last starts of the runs of repeated windows, for texts that have any."""
    packed = _written(texts.select("h", "text").mapInArrow(_list_minimizers(width), "keys binary, marks binary, names binary"), f"{folder}/minimizers")
    counted = packed.select("keys").mapInArrow(_count_minimizers, "key long, n long")
    often = durable(counted.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key", (F.col("n") > HOT).alias("hot")))
    broadcast = texts.sparkSession.sparkContext.broadcast  # of 1 << BITMAP_BITS bits each
    if often.count() < SPARSE:
        shared = broadcast((_marked(often), _marked(often.where("hot"))))
        listed = packed.mapInArrow(_grouped_marks(shared), f"h binary, marks {_MARKS}")
        # Copies of a long text may be cut into lists in different ways: marks that repeat are dropped where chunks are cut.
        marks = listed.groupBy("h").agg(F.flatten(F.collect_set("marks")).alias("marks"))
    else:
        listed = _written(packed.mapInArrow(_repeated_marks(broadcast(_marked(often))), _MARK), f"{folder}/marks")
        marks = join_frequent(listed, often, "key").groupBy("h").agg(F.collect_set(F.struct("first", "last", "at", "key", "hot")).alias("marks"))
    marks = _written(marks, f"{folder}/runs")
    cut = join_frequent(_only(texts, marks), marks, "h", keys=names).select("h", "text", "marks").mapInArrow(_cut_chunks(width), _CHUNK)
    chunks = _written(cut, f"{folder}/chunks")
    bodies = chunks.where("chunk is not null").select("key", "cid", "chunk", "m")
    found = durable(bodies.repartition("key").sortWithinPartitions("key", "cid").mapInArrow(_transform(width, CHUNKS, GROUP_BYTES), _FOUND))
    answers = found.where("chunk is null").select("cid", "first", "last")
    todo = found.where("chunk is not null")
    if not todo.isEmpty():
        answers = durable(answers.unionByName(_window_by_window(todo, width)))
    joined = join_frequent(chunks.where("h is not null").select("h", "start", "cid"), answers, "cid")
    each = joined.select("h", "start", F.explode(F.arrays_zip("first", "last")).alias("x"))
    hit = F.struct((F.col("start") + F.col("x.first")).alias("a"), (F.col("start") + F.col("x.last")).alias("z"))
    return _written(each.groupBy("h").agg(F.collect_set(hit).alias("hits")), f"{folder}/hits")


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 200, outputs: tuple[str, ...] = ("spans", "kept")) -> DataFrame:
    """``doc_id, n_bytes`` and the named outputs, a row per row: spans (removed byte ranges), kept (the remaining bytes), n_removed, n_spans, kept_sha256.

    What is shared by tasks is written below the shared folder and deleted at the end.
    """
    if width < GRAM + STEP:
        raise ValueError(f"strings of under {GRAM + STEP} bytes are not supported")
    spark = docs.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/repeats-{uuid.uuid4().hex}"
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = spread(docs.select(F.col(key).alias("doc_id"), body.alias("text")).withColumn("h", F.unhex(F.md5("text"))))
    names = durable(rows.select("h"))
    hits = _hits(rows.select("h", "text"), names, width, folder)
    schema = ", ".join(["h binary", *(f"{o} {_TYPES[o]}" for o in outputs)])
    edited = join_frequent(_only(rows, hits), hits, "h", keys=names).select("h", "text", "hits").mapInArrow(_finish(width, outputs), schema)
    done = durable(edited.dropDuplicates(["h"]).withColumnsRenamed({o: f"_{o}" for o in outputs}).withColumn("_hit", F.lit(True)))
    whole = rows.select("doc_id", "h", F.octet_length("text").cast("long").alias("n_bytes"), *[_whole(o) for o in outputs])
    joined = join_frequent(whole, done, "h", how="left", keys=names)
    out = durable(joined.select("doc_id", "n_bytes", *[F.when(F.col("_hit"), F.col(f"_{o}")).otherwise(F.col(o)).alias(o) for o in outputs]))
    remove_folder(spark, folder)
    return out
