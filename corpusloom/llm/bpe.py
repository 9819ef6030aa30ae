"""Byte-level BPE encoding and decoding through a table of distinct words.

A text is cut at white space so that every piece starts a new match of the tokenizer's own pattern;
such a word has the same ids wherever it stands. Tasks cut their texts into blocks of some MB and list
the distinct words of a block, dealt by hash; Spark brings equal words of all blocks to one task,
which encodes each once with the tokenizers library and answers every block with its words' ids.
Ids then meet their texts by block, are joined back by position, and are decoded through the table of
pieces by id (a vocabulary of fixed size). Words, answers and texts travel packed, so that a billion
words are not a billion rows.

A block is rebuilt from the rows in the order of its partition. Should an input come back in another
order when a lost task runs again, the checksum of a word list differs and the words are encoded on
the spot; answers for a block that the texts do not make are dropped. The result is the same.

Defined cases: a null text is the empty one (no ids); the strings of added tokens become those tokens,
as the library does; texts are taken whole; repeated rows each get a row; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BLOCK_BYTES = 8 << 20
#: How hard texts, words and answers are compressed for the shuffle.
LEVEL = 9
#: Ids that are decoded together.
DECODED = 1 << 18
#: Unicode White_Space, the tokenizer pattern's \\s. Fixed values.
_SPACE = "\t-\r \x85\xa0  -     　"
_UNIT = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


class Codec:
    """A byte-level tokenizer file, read once per process."""

    _open: dict[str, Codec] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        first = json.loads(self.library.pre_tokenizer.__getstate__()) if self.library.pre_tokenizer else {"type": None}
        if first["type"] != "ByteLevel" or first["add_prefix_space"] or not first["use_regex"] or self.library.normalizer:
            raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
        added = self.library.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("added tokens must match plainly")
        self.library.no_truncation()
        self.library.no_padding()
        strings = sorted((t.content for t in added.values()), key=lambda c: (-len(c), c))
        self.added = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None
        # Printable bytes stand for themselves; the others are code points from 256 on, in order.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        pieces = self.library.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(pieces.values()) + 1)
        for piece, i in pieces.items():
            known = all(c in byte_of for c in piece)
            self.pieces[i] = bytes(byte_of[c] for c in piece) if known else piece.encode()
        self.wire = "<u2" if len(self.pieces) <= 1 << 16 else "<u4"  # of ids between tasks
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.flat = np.frombuffer(b"".join(self.pieces), np.uint8)

    @classmethod
    def of(cls, path: str) -> Codec:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def words(self, text: str) -> list[str]:
        if self.added is None or not self.added.search(text):
            return _UNIT.findall(text)
        out = []
        for i, part in enumerate(self.added.split(text)):
            out += [part] if i % 2 else _UNIT.findall(part)
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        out = []
        for i in range(0, len(words), 4096):
            for e in self.library.encode_batch_fast(words[i : i + 4096], add_special_tokens=False):
                ids = e.ids
                out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The pieces of ``ids`` put together; bytes that are no UTF-8 become U+FFFD."""
        parts = [ids[i : i + DECODED] for i in range(0, len(ids), DECODED)]
        return b"".join(_gathered(self.flat, self.starts[p], self.lengths[p]).tobytes() for p in parts).decode("utf-8", "replace")


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` that begin at ``starts``, one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, pa.Array, list[str]]]:
    """(block id, keys, texts) in row order; where a block ends depends on its texts alone."""
    part, seq, used, keys, texts = TaskContext.get().partitionId(), 0, 0, [], []
    for batch in batches:
        start = 0
        for i, t in enumerate(batch.column(1).to_pylist()):
            texts.append(t)
            used += len(t) + 64
            if used >= size:
                keys.append(batch.column(0).slice(start, i + 1 - start))
                yield f"{part}:{seq}", pa.concat_arrays(keys), texts
                seq, used, keys, texts, start = seq + 1, 0, [], [], i + 1
        if start < batch.num_rows:
            keys.append(batch.column(0).slice(start))
    if texts:
        yield f"{part}:{seq}", pa.concat_arrays(keys), texts


def _numbered(codec: Codec, texts: list[str]) -> tuple[dict[str, int], list[np.ndarray]]:
    """The distinct words of a block by first use, and each text as their numbers."""
    seen: defaultdict[str, int] = defaultdict(count().__next__)
    number = seen.__getitem__
    return seen, [np.fromiter(map(number, w), np.int32, len(w)) for w in map(codec.words, texts)]


def _dealt(words: Iterable[str], parts: int) -> list[list[str]]:
    """Words by part, in their order."""
    out: list[list[str]] = [[] for _ in range(parts)]
    digest = xxhash.xxh32_intdigest
    for w in words:
        out[digest(w) % parts].append(w)
    return out


def _pack_words(words: list[str]) -> bytes:
    return zstandard.compress("\0".join(w.replace("\0", "\0\0") if "\0" in w else w for w in words).encode(), LEVEL) if not any("\0" in w for w in words) else b"J" + json.dumps(words).encode()


def _unpack_words(blob: bytes) -> list[str]:
    return json.loads(blob[1:]) if blob[:1] == b"J" else zstandard.decompress(blob).decode().split("\0")


def _row(block: str, part: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part], pa.int32()), pa.array([blob], pa.binary())], ["block", "part", "blob"])


def _list_words(path: str, parts: int, size: int):
    def run(batches):
        codec = Codec.of(path)
        for block, _, texts in _blocks(batches, size):
            seen: dict[str, None] = {}
            for t in texts:
                seen.update(dict.fromkeys(codec.words(t)))
            for part, words in enumerate(_dealt(seen, parts)):
                if words:
                    yield _row(block, part, _pack_words(words))

    return run


def _answer(path: str):
    """Each distinct word of a part is encoded once; each block gets its words' ids in its own order."""

    def run(batches):
        codec, known, last = Codec.of(path), {}, None
        for batch in batches:
            for block, part, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if part != last:  # rows come sorted by part
                    known, last = {}, part
                words = _unpack_words(blob)
                new = [w for w in words if w not in known]
                known.update(zip(new, codec.encode_words(new)))
                ids = [known[w] for w in words]
                lengths = np.array([len(x) // 4 for x in ids], np.uint32)
                packed = lengths.tobytes() + np.frombuffer(b"".join(ids), "<u4").astype(codec.wire).tobytes()
                yield _row(block, part, struct.pack("<QI", xxhash.xxh64_intdigest(blob), len(ids)) + zstandard.compress(packed, LEVEL))

    return run


def _pack_texts(size: int):
    def run(batches):
        for block, keys, texts in _blocks(batches, size):
            sink = pa.BufferOutputStream()
            table = pa.record_batch([keys, pa.array(texts, pa.large_string())], ["doc_id", "text"])
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_batch(table)
            yield _row(block, -1, zstandard.compress(sink.getvalue(), LEVEL))

    return run


def _join_back(path: str, parts: int, outputs: tuple[str, ...], schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        codec, answers, packed = Codec.of(path), {}, None
        for part, blob in zip(table.column("part").to_pylist(), table.column("blob").to_pylist()):
            if part < 0:
                packed = blob
            else:
                answers[part] = blob
        if packed is None:  # the texts came in another order and make fewer blocks: no row is in this one
            return schema.empty_table()
        rows = pa.ipc.open_stream(zstandard.decompress(packed)).read_all()
        del packed
        seen, each = _numbered(codec, rows.column("text").to_pylist())
        found: list[bytes] = [b""] * len(seen)
        for part, words in enumerate(_dealt(seen, parts)):
            if not words:
                continue
            check, n = struct.unpack_from("<QI", answers.get(part, b"\0" * 12))
            if n != len(words) or check != xxhash.xxh64_intdigest(_pack_words(words)):
                ids = codec.encode_words(words)
            else:
                raw = zstandard.decompress(answers.pop(part)[12:])
                ends = (4 * np.cumsum(np.frombuffer(raw, np.uint32, n), dtype=np.int64)).tolist()
                flat = np.frombuffer(raw, codec.wire, offset=4 * n).astype("<u4").tobytes()
                ids = [flat[a:z] for a, z in zip([0, *ends[:-1]], ends)]
            for w, x in zip(words, ids):
                found[seen[w]] = x
        del seen
        # Back by position: the ids of a word stand together in one flat array.
        lengths = np.array([len(x) // 4 for x in found], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)))[: len(found)]
        table, found = np.frombuffer(b"".join(found), "<u4"), []
        whole = [_gathered(table, starts[w], lengths[w]) for w in each]
        del each, table
        counts = np.array([len(x) for x in whole], np.int64)
        out: dict[str, pa.Array] = {"doc_id": rows.column("doc_id").combine_chunks()}
        del rows
        if "n_tokens" in outputs:
            out["n_tokens"] = pa.array(counts)
        if "ids_sha256" in outputs:
            out["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in whole], pa.string())
        if "ids" in outputs:
            flat = np.concatenate(whole) if whole else np.zeros(0, "<u4")
            out["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(flat.view(np.int32)))
        if {"decoded", "decoded_sha256"} & set(outputs):
            texts = [codec.decode(x) for x in whole]
            if "decoded" in outputs:
                out["decoded"] = pa.array(texts, pa.string())
            if "decoded_sha256" in outputs:
                out["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
        return pa.table({k: out[k] for k in ("doc_id", *outputs)})

    return run


_TYPES = {"n_tokens": "long", "ids_sha256": "string", "ids": "array<int>", "decoded": "string", "decoded_sha256": "string"}


def encode(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text", outputs: tuple[str, ...] = ("n_tokens", "ids"), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id`` and the named outputs, a row per row: n_tokens, ids, ids_sha256, decoded, decoded_sha256.

    ``vocabulary`` is the path of a tokenizers file that every executor can open.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shape = "block string, part int, blob binary"
    words = rows.mapInArrow(_list_words(vocabulary, parts, block_bytes), shape)
    answers = words.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_answer(vocabulary), shape)
    texts = rows.mapInArrow(_pack_texts(block_bytes), shape)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"{o} {_TYPES[o]}" for o in outputs)])
    return texts.unionByName(answers).groupBy("block").applyInArrow(_join_back(vocabulary, parts, outputs, to_arrow_schema(StructType.fromDDL(schema))), schema)


def pieces(spark, vocabulary: str) -> DataFrame:
    """``id, piece`` (bytes): one row for each entry of the vocabulary, whose size is fixed."""
    return spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(Codec(vocabulary).pieces)], "id int, piece binary")


def decode(encoded: DataFrame, vocabulary: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text``: ids joined with their pieces by id and put together by position.

    Keys must be unique; one of them may be null. The table of pieces is broadcast: its size is that of the vocabulary. An
    empty list gives the empty text, a null list a null; bytes that are no UTF-8 become U+FFFD.
    """
    spread = encoded.select(F.col(key), F.posexplode(F.col(ids)).alias("_p", "id"))
    joined = spread.join(F.broadcast(pieces(encoded.sparkSession, vocabulary)), "id")
    parts = F.array_sort(F.collect_list(F.struct("_p", "piece")))
    merged = joined.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: F.hex(x["piece"])), "").alias("_hex"))
    rows = encoded.select(F.col(key), F.col(ids).isNull().alias("_null"))
    rows = rows.join(merged.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "left")
    whole = F.decode(F.unhex(F.coalesce("_hex", F.lit(""))), "UTF-8")
    return rows.select(key, F.when(~F.col("_null"), whole).alias("text"))
