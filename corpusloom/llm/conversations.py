"""Conversation structure repair by dynamic programs that share a prefix trie.

A turn is reduced to one symbol: its role's class and its fault. A conversation's symbols in turn order
are its signature. Equal signatures are one row from the start; the distinct ones are dealt by range and
sorted, so that a walk through them is a walk through their prefix trie: the layers of the dynamic
program lie on a stack, the layers of the prefix that two neighbours share are computed once, and the
answer of a signature is read off where it ends (its terminal node).

A layer holds, for each of four states (nothing kept, a system turn, a user turn, an assistant turn
last), the least cost, the layer's state before, the letters of the step and the place of the edit
string among those of the layer. Every edit string of a layer has one letter K, R or D for each turn so
far and ends with one, so none begins another and two strings compare as (place before, letters): a
layer has a fixed size, however long the conversation. An insertion before a deletion is never offered:
the deletion before the insertion costs the same and sorts first.

Texts are shuffled twice: to number turns and find repeats, and to write repaired turns. Both walk a
sorted partition as a stream, so a conversation is never held as a whole. Its edit string is one value
of the result and does fit.

Defined cases: null roles, texts, ids and turns are one space where they are read as strings; null turns
come first; turns of equal number stand by role, then text; repeated rows are repeated turns; a null
conv_id is a conversation of its own; a role is known by its first character, and one that begins with
neither s, u nor a never fits; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import durable, join_frequent

_BLANK = " \t\n\x0b\x0c\r"
#: A turn that must go, then the role classes (o: any other), in upper case if the text is truncated.
SYMBOLS = "xsuaoSUAO"
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: For each state: what an insertion leads to, what a kept role leads to, what a new role leads to. Fixed by the grammar (s?(ua)+)?.
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_INSERTED = (_USER, _USER, _ASSISTANT, _USER)
_KEPT = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after one of five faults in some turns, by the CRC32 of ``conv_id:turn``; ``gone`` marks dropped turns.

    Of twenty remainders 0 drops the turn, 1 empties its text, 2 takes its ``. ! ?`` out, 3 repeats it, 4 makes it the user's.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    hurt = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    found = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"), hurt.alias("text"), (kind == 0).alias("gone"), kind.alias("_kind"))
    twice = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return found.withColumn("_copy", F.explode(twice)).drop("_kind", "_copy")


def diagnose(turns: DataFrame) -> DataFrame:
    """A row for each conv_id of ``turns`` (``gone`` rows only name their conversation): ``gaps, blank, duplicate, truncated, illegal, signature``."""
    initial = F.substring("role", 1, 1)
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("_i"))
    last = F.right(F.rtrim("text", F.lit(_BLANK)), F.lit(1))
    numbered = turns.where("not gone").select("*", F.row_number().over(ordered).alias("_i"), F.lag(initial).over(ordered).alias("_before"))
    before = F.col("_before")
    known = numbered.select(
        "conv_id",
        "turn",
        "_i",
        F.when(last == "", 1).when(again > 1, 2).when(~last.isin(".", "!", "?"), 3).otherwise(0).alias("_fault"),
        (before.isNotNull() & ~F.concat(before, initial).isin("su", "ua", "au")).cast("long").alias("_illegal"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("_class"),
    )
    symbol = F.when(F.col("_fault").isin(1, 2), "x").when(F.col("_fault") == 3, F.upper("_class")).otherwise(F.col("_class"))
    count = lambda n: F.sum((F.col("_fault") == n).cast("long"))
    found = known.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        count(1).alias("blank"),
        count(2).alias("duplicate"),
        count(3).alias("truncated"),
        F.sum("_illegal").alias("illegal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", symbol.alias("s")))), lambda x: x["s"]), "").alias("signature"),
    )
    every = turns.select(F.col("conv_id").alias("_c")).distinct()
    joined = every.join(found, F.col("_c").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")]
    return joined.select(F.col("_c").alias("conv_id"), *numbers, F.coalesce("signature", F.lit("")).alias("signature"))


_Step = tuple[int, int, str, int]  # cost, state before, letters, place among the layer's strings
_Layer = tuple[_Step | None, ...]
ROOT: _Layer = ((0, 0, "", 0), None, None, None)


def next_layer(layer: _Layer, symbol: str) -> _Layer:
    """The layer behind one more turn."""
    offers: list[list[tuple[int, int, str, int]]] = [[], [], [], []]
    role, extra = symbol.lower(), int(symbol.isupper())
    for state, step in enumerate(layer):
        if step is None:
            continue
        cost, place = step[0], step[3]
        offers[state].append((cost + DELETE, place, "D", state))
        if symbol == "x":
            continue
        for at, paid, letters in ((state, cost + extra, ""), (_INSERTED[state], cost + extra + INSERT, "I")):
            if role in _KEPT[at]:
                offers[_KEPT[at][role]].append((paid + KEEP, place, letters + "K", state))
            offers[_INSERTED[at]].append((paid + REROLE, place, letters + "R", state))
    best = [min(o) if o else None for o in offers]
    places = {p: i for i, p in enumerate(sorted(b[1:3] for b in best if b))}
    return tuple(b and (b[0], b[3], b[2], places[b[1:3]]) for b in best)


def cheapest(layers: list[_Layer]) -> tuple[int, str]:
    """The least cost and the least edit string behind the last of ``layers``, which begin with ``ROOT``."""
    ends = []
    for state, close in ((_EMPTY, ""), (_SYSTEM, "II"), (_USER, "I"), (_ASSISTANT, "")):
        if step := layers[-1][state]:
            ends.append((step[0] + INSERT * len(close), step[3], close, state))
    cost, _, close, state = min(ends)
    letters = [close]
    for layer in reversed(layers[1:]):
        _, before, step, _ = layer[state]
        letters.append(step)
        state = before
    return cost, "".join(reversed(letters))


def walk_trie(signatures: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """(signature, cost, audit) of sorted signatures; layers of a shared prefix are computed once."""
    last, layers = "", [ROOT]
    for signature in signatures:
        shared = len(commonprefix([last, signature]))
        del layers[shared + 1 :]
        for symbol in signature[shared:]:
            layers.append(next_layer(layers[-1], symbol))
        last = signature
        yield signature, *cheapest(layers)


def audits(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` for every distinct signature."""

    schema = "signature string, cost long, audit string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(walk_trie(s for batch in batches for s in batch.column(0).to_pylist()), arrow)

    parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = signatures.select("signature").distinct().repartitionByRange(parts, "signature").sortWithinPartitions("signature")
    return dealt.mapInArrow(run, schema)


def repair(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, signature, cost, audit``: faults and cheapest edits of every conversation."""
    found = durable(diagnose(turns))
    answers = durable(audits(found))
    return join_frequent(found, answers, "signature")


class _Writer:
    """Repaired turns (number, role, text, edit) of one conversation, handed out as its turns come by."""

    def __init__(self, audit: str):
        self.letters, self.last, self.n = iter(audit), "", 0

    def _out(self, role: str, text: str, edit: str) -> tuple[int, str, str, str]:
        self.last, self.n = role[:1], self.n + 1
        return self.n, role, text, edit

    def _next_role(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def turn(self, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        while (letter := next(self.letters)) == "I":
            yield self._out(self._next_role(), "", "I")
        if letter != "D":
            yield self._out(role if letter == "K" else self._next_role(), text, letter)

    def rest(self) -> Iterator[tuple[int, str, str, str]]:
        for _ in self.letters:
            yield self._out(self._next_role(), "", "I")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple | None, tuple | None]]:
    """(head, None) where a conversation begins, then (None, repaired turn) for each of its turns."""
    writer = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for is_turn, role, text, *head in zip(*columns):
            if is_turn:
                for found in writer.turn(role, text):
                    yield None, found
                continue
            if writer:
                for found in writer.rest():
                    yield None, found
            writer = _Writer(head[-1])
            yield tuple(head), None
    if writer:
        for found in writer.rest():
            yield None, found


def _streamed(turns: DataFrame, repaired: DataFrame, columns: list[str]) -> DataFrame:
    """Each conversation's row of ``repaired`` with its turns behind it, in one partition."""
    heads = repaired.select("conv_id", F.lit(False).alias("_turn"), *columns)
    rows = turns.where("not gone").select("conv_id", F.lit(True).alias("_turn"), "turn", "role", "text")
    both = rows.unionByName(heads, allowMissingColumns=True).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "_turn", "turn", "role", "text").select("_turn", "role", "text", "conv_id", *columns)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows``, bounded by number and by the length of their strings."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) == 4096 or size > 1 << 24:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired_turns(turns: DataFrame, repaired: DataFrame) -> DataFrame:
    """``conv_id, n, role, text, edit``: the turns that ``repair`` leaves, numbered from 1; edit is K, R or I."""
    schema = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, n int, role string, text string, edit string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            own = None
            for head, line in _walk(batches):
                if head:
                    own = head[0]
                else:
                    yield own, *line

        yield from _batches(rows(), arrow)

    return _streamed(turns, repaired, ["audit"]).mapInArrow(run, schema)


def digests(turns: DataFrame, repaired: DataFrame) -> DataFrame:
    """``repaired`` with ``repaired_sha256``: the SHA-256 of the repaired ``role:text``, joined by newlines."""
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    types = {f.name: f.dataType.simpleString() for f in repaired.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in ["conv_id", *columns]) + ", repaired_sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            own, sha = None, None
            for head, line in _walk(batches):
                if head:
                    if own:
                        yield *own, sha.hexdigest()
                    own, sha = head, hashlib.sha256()
                else:
                    n, role, text, _ = line
                    sha.update(f"{chr(10) if n > 1 else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            if own:
                yield *own, sha.hexdigest()

        yield from _batches(rows(), arrow)

    return _streamed(turns, repaired, columns).mapInArrow(run, schema)
