from __future__ import annotations

import hashlib
import random
import struct
import sys

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import bpe, jpeg

from .data import docs, empty, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def by_words(text: str) -> list[int]:
    codec = bpe.Codec.of(PATH)
    data = b"".join(codec.encode_words(codec.words(text)))
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdlé1\x85\xa0 　\x1c\x1f"))))
def test_words_give_the_library_ids(library, text):
    text = text.replace("E", "<|endoftext|>")
    assert by_words(text) == library.encode(text, add_special_tokens=False).ids


def test_every_character_between_spaces(library):
    for low in range(0, sys.maxunicode, 4096):
        chars = [chr(c) for c in range(low, min(low + 4096, sys.maxunicode + 1)) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a {c} {c}b  {c}\n" for c in chars[:: 1 if low < 0x20000 else 512])
        assert by_words(text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("block", [bpe.BLOCK_BYTES, 200])
def test_encode_equals_the_library(spark, library, block):
    got = bpe.encode(docs(spark), PATH, outputs=("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"), block_bytes=block).collect()
    want = []
    for r in rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), ids, hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), text, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert bpe.encode(empty(spark), PATH).count() == 0


def test_a_changed_order_is_encoded_on_the_spot(library):
    """If a block's words are not those that were answered, its own words are encoded."""
    import pyarrow as pa
    import zstandard

    sink = pa.BufferOutputStream()
    table = pa.record_batch([pa.array([1]), pa.array(["some other text"], pa.large_string())], ["doc_id", "text"])
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_batch(table)
    rows_ = pa.table({"block": ["b", "b"], "part": [-1, 0], "blob": [zstandard.compress(sink.getvalue()), struct.pack("<QI", 1, 3)]})
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    assert bpe._join_back(PATH, 1, ("ids",), schema)(rows_).to_pylist()[0]["ids"] == library.encode("some other text").ids


def test_a_changed_order_may_make_fewer_blocks(spark, library, monkeypatch):
    """Words of the order that makes two blocks, texts of the order that makes one: every text is answered once."""
    texts = ["a " * 40, "b", "c " * 40]
    one, two = (spark.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string").coalesce(1) for order in ((0, 2, 1), (1, 0, 2)))
    size = 200
    cut = lambda frame: {r.block for r in frame.mapInArrow(bpe._list_words(PATH, 2, size), "block string, part int, blob binary").collect()}
    few, many = sorted((one, two), key=lambda f: len(cut(f)))
    if len(cut(few)) == len(cut(many)):
        few = few.limit(1).coalesce(1)
    assert len(cut(few)) < len(cut(many))
    calls = iter((many, few))
    plain = type(many).mapInArrow

    def in_turns(frame, run, schema, *more, **named):
        """The words are listed from one order, the texts packed from the other."""
        return plain(next(calls) if frame.columns == ["doc_id", "text"] else frame, run, schema, *more, **named)

    monkeypatch.setattr(type(many), "mapInArrow", in_turns)
    found = bpe.encode(many, PATH, outputs=("ids",), block_bytes=size)
    monkeypatch.undo()
    got = {r.doc_id: r.ids for r in found.collect()}
    assert got and all(ids == library.encode(texts[i]).ids for i, ids in got.items())
    assert set(got) == {r.doc_id for r in few.collect()}


def test_decode_finds_a_null_key(spark):
    frame = spark.createDataFrame([(None, [1, 2, 3]), (4, [5])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(frame, PATH).collect()}
    assert got == {None: "\"#$", 4: "&"}


def test_decode_joins_pieces(spark):
    frame = bpe.encode(docs(spark).where("doc_id in (103, 104, 101, 8)"), PATH, outputs=("ids", "decoded"))
    back = {r.doc_id: r.text for r in bpe.decode(frame, PATH).collect()}
    assert back == {r.doc_id: r.decoded for r in frame.collect()}


PAYLOADS = [b"\0" * 64, bytes(range(256)), b"\xff" * 192, np.random.default_rng(1).bytes(64 * 300), b"ab" * 32 * 9000]


def test_jpeg_round_trip(monkeypatch):
    media = jpeg.write(PAYLOADS)
    frames = jpeg.read(media)
    assert [jpeg.payload(f) for f in frames] == PAYLOADS
    assert all(m[:2] == b"\xff\xd8" and m[-2:] == b"\xff\xd9" for m in media)
    assert [f[0].width % 512 for f in frames] == [0] * 5 and frames[4][0].width > 512
    monkeypatch.setattr(jpeg, "FRAME_BYTES", 128)
    several = jpeg.read(jpeg.write(PAYLOADS[:4]))
    assert [jpeg.payload(f) for f in several] == PAYLOADS[:4] and len(several[1]) == 2


def colour_jpeg(restart: bool) -> tuple[bytes, np.ndarray]:
    """A 4:2:0 picture of 32x32 with random DC terms and some AC terms, written a bit at a time."""
    rng = random.Random(6)
    ac_values = (0x00, 0x01, 0x12, 0xF0, 0x03)
    dc, ac = jpeg._codes(jpeg.DC_BITS, jpeg.DC_VALUES), jpeg._codes((0, 1, 3, 1, *[0] * 12), ac_values)
    bits, out, last = "", bytearray(), [0, 0, 0]
    luma = np.zeros((4, 4), int)

    def put(code):
        return format(code[0], f"0{code[1]}b")

    def flush(text):
        data = int(text + "1" * (-len(text) % 8) or "0", 2).to_bytes((len(text) + 7) // 8, "big")
        return data.replace(b"\xff", b"\xff\x00")

    for m in range(4):
        if restart and m:
            out += flush(bits) + bytes([0xFF, 0xD0 + m - 1])
            bits, last = "", [0, 0, 0]
        for c in (0, 0, 0, 0, 1, 2):
            value = rng.randint(-100, 100)
            if c == 0:
                b = sum(1 for _ in range(0)) + colour_jpeg.count
                luma[2 * (m // 2) + b // 2, 2 * (m % 2) + b % 2] = value
                colour_jpeg.count = (b + 1) % 4
            d = value - last[c]
            last[c] = value
            size = abs(d).bit_length()
            bits += put(dc[size]) + (format(d if d > 0 else d + (1 << size) - 1, f"0{size}b") if size else "")
            for symbol in rng.sample((0x01, 0x12, 0xF0, 0x03), rng.randint(0, 3)):
                bits += put(ac[symbol]) + "".join(rng.choice("01") for _ in range(symbol & 15))
            bits += put(ac[0x00])
    out += flush(bits)
    head = b"\xff\xd8" + jpeg._segment(0xDB, b"\0" + bytes([4] + [1] * 63))
    head += jpeg._segment(0xC0, struct.pack(">BHHB", 8, 32, 32, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    head += jpeg._segment(0xC4, b"\x00" + bytes(jpeg.DC_BITS) + bytes(jpeg.DC_VALUES)) + jpeg._segment(0xC4, b"\x10" + bytes((0, 1, 3, 1, *[0] * 12)) + bytes(ac_values))
    head += jpeg._segment(0xDD, struct.pack(">H", 1)) if restart else b""
    head += jpeg._segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0]))
    return head + bytes(out) + b"\xff\xd9", np.clip(np.rint(luma * 4 / 8) + 128, 0, 255).astype(np.uint8)


colour_jpeg.count = 0


@pytest.mark.parametrize("restart", [False, True])
def test_jpeg_of_other_writers(restart):
    data, luma = colour_jpeg(restart)
    ((frame,),) = jpeg.read([data])
    assert (frame.width, frame.height) == (32, 32) and np.array_equal(frame.luma, luma)


def test_jpeg_refuses_what_it_does_not_read():
    for bad in (b"GIF89a", b"\xff\xd8\xff\xc2\x00\x04\x00\x00", jpeg.write(PAYLOADS[:1])[0][:-40]):
        with pytest.raises((ValueError, IndexError)):
            jpeg.read([bad])
    with pytest.raises(ValueError):
        jpeg.write([b"x"])


def test_media_digests(spark):
    import zlib

    got = jpeg.digests(jpeg.store(docs(spark))).collect()
    assert len(got) == len(rows()) and jpeg.digests(jpeg.store(empty(spark))).count() == 0
    texts = {}
    for r in rows():
        n, p = jpeg.padded(r[1])
        texts[r[0], n] = p
    for r in got:
        p = texts[r.doc_id, r.n_bytes]
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    same = {(r.media_sha256, r.feature) for r in got if r.doc_id in (0, 3, 6)}
    assert len(same) == 1
