"""Personal data by bootstrapped contextual extraction.

Four base patterns (email, ip, card, phone) give the seed entities of every whole text; long runs of
hexadecimal digits seed a fifth kind, ``secret``. Looser shapes of the same kinds ("name at host dot
com", a phone number without a plus sign, a shortened IPv6 address, a card number with a wrong check
digit, a token of letters and digits ...) are only candidates. The one, two and three tokens before an
entity, and the tokens on both of its sides, are its lexical patterns; a token is a run of letters and
digits or one other mark, so that ``token = "`` is a pattern.

Patterns and instances form a graph that Spark scores in rounds. A pattern is eligible while enough
different believed instances stand at it; its confidence is the score of the instances it introduces
over all the places it stands at in the corpus, ordinary words included; an instance is believed by
the eligible patterns that introduce it. Rounds end when nothing new is trusted, so an identifier that
was found teaches further patterns. Every occurrence of a believed instance is added to the spans.

The corpus is read a second time only if some candidate shares a pattern with enough instances, to
count the places of patterns. They are picked by a bitmap of a fixed size; what it picks beyond the
patterns that are asked for falls to the join behind it.

Defined cases: a null text is empty; offsets are code points, ends exclusive; base matches that fail
their test are dropped without a retry; added spans never overlap base spans or one another (the
first, then the longest, stays); rows repeat as they stand; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits begins, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
#: Shorter runs are dropped by their number of digits in any case.
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT = r"(?:[ ]?[\[(][ ]?at[ ]?[\])][ ]?|[ ]at[ ])"
_DOT = r"(?:[ ]?[\[(][ ]?dot[ ]?[\])][ ]?|[ ]dot[ ]|\.)"
#: (kind, shape, what must stand in the text) of the candidates. Every shape is linear in the text.
_LOOSE = (
    (0, re.compile(rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{{1,64}}{_AT}[a-z0-9-]{{1,63}}{_DOT}[a-z]{{2,}}"), re.compile(r"(?i)\bdot\b|[\[(][ ]?at[ ]?[\])]")),
    (1, re.compile(r"(?<![0-9A-Za-z.:])[0-9A-Fa-f]{0,4}(?:(?:::|:|\.)[0-9A-Fa-f]{1,4}){2,7}(?![0-9A-Za-z:])"), re.compile(r"[0-9A-Fa-f][.:][0-9A-Fa-f:]|::[0-9A-Fa-f]")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}(?![0-9])"), re.compile(r"[0-9]{3}")),
    (3, re.compile(r"(?<![0-9A-Za-z+(])[(]?[0-9]{2,5}(?:[ ().-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z])|(?<![0-9A-Za-z+])00[1-9][0-9]{8,12}(?![0-9A-Za-z])"), re.compile(r"[0-9]{2}[ ().-]{1,2}[0-9]{2}|00[1-9][0-9]{8}")),
    (4, re.compile(r"(?<![0-9A-Za-z+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[0-9A-Za-z][0-9A-Za-z+/_=-]{7,}"), re.compile(r"[0-9]")),
)
_LEAST_DIGITS = (0, 2, 13, 7, 1)
#: One of these stands in every spelled address; without a digit there is no other candidate.
_SPELLED, _DIGIT = ("dot", "[at", "[ at", "(at", "( at"), re.compile("[0-9]")
_HEX = re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}")
_TOKEN = re.compile(r"\s*(?:[^\W_]+|[^\w\s]|_)")
BITMAP_BITS = 26
#: Growth of all scores together that ends the rounds, and the number of rounds that is an error.
STILL, MOST_ROUNDS = 1e-3, 200


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in that order."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            out.append((start, 0, last))
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, seed) of candidates that overlap nothing in ``taken``, which is sorted; they may overlap one another."""
    out: list[tuple[int, int, int, bool]] = []
    ends = sorted(z for _, _, z in taken)
    starts = sorted(a for a, _, _ in taken)
    lower = text.lower()
    digits = _DIGIT.search(text) is not None
    for kind, shape, hint in _LOOSE:
        if not (digits if kind else any(h in lower for h in _SPELLED)) or hint.search(text) is None:
            continue
        for m in shape.finditer(text):
            a, z = m.span()
            if kind and sum(map(str.isdigit, m[0])) < _LEAST_DIGITS[kind]:
                continue
            if bisect_left(starts, z) == bisect_left(ends, a + 1):  # all that begin before its end end before its start
                out.append((a, kind, z, kind == 4 and _HEX.fullmatch(m[0]) is not None))
    return sorted(out)


class _TokenHashes(dict):
    """XXH64 of each token in lower case; forgotten when there are too many to hold."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        self[token] = found = xxhash.xxh64_intdigest(token.strip().lower())
        return found


_known = _TokenHashes()
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _hashes(raw: list[str]) -> np.ndarray:
    return np.fromiter(map(_known.__getitem__, raw), np.uint64, len(raw))


def _tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends) of the tokens of a whole text."""
    raw = _TOKEN.findall(text)
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    starts = ends - np.fromiter((len(x.lstrip()) for x in raw), np.int64, len(raw))
    return _hashes(raw), starts, ends


def _mixed(kind: int, *parts):
    out = np.uint64(kind)
    for p in parts:
        out = (out ^ p) * _ODD
        out = out ^ (out >> np.uint64(29))
    return out


def _all_patterns(h: np.ndarray) -> list[np.ndarray]:
    """For each kind of pattern its hash at every place: one, two, three tokens, and the tokens around one place."""
    return [_mixed(1, h), _mixed(2, h[:-1], h[1:]), _mixed(3, h[:-2], h[1:-1], h[2:]), _mixed(4, h[:-2], h[2:])]


def _patterns(text: str, spans: list[tuple]) -> list[list[int]]:
    """The hashes of the patterns that each span stands at."""
    if not spans:
        return []
    h, starts, ends = _tokens(text)
    out = []
    with np.errstate(over="ignore"):
        for a, _, z, *_ in spans:
            i, j = int(np.searchsorted(ends, a, "right")) - 1, int(np.searchsorted(starts, z))
            mine = []
            if i >= 0 and not text[int(ends[i]) : a].strip():
                mine.append(_mixed(1, h[i]))
                if i >= 1:
                    mine.append(_mixed(2, h[i - 1], h[i]))
                if i >= 2:
                    mine.append(_mixed(3, h[i - 2], h[i - 1], h[i]))
                if j < len(h) and not text[z : int(starts[j])].strip():
                    mine.append(_mixed(4, h[i], h[j]))
            out.append([int(np.uint64(x).astype(np.int64)) for x in mine])
    return out


def _instance(text: str) -> int:
    return xxhash.xxh64_intdigest("".join(c for c in text.lower() if c.isalnum())) - (1 << 63)


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


_SPAN = "struct<start:int,kind:int,end:int>"
_EDGE = "struct<kind:int,start:int,end:int,instance:bigint,base:boolean,seed:boolean,patterns:array<bigint>>"


def _extract(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    edge_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.int64()), ("base", pa.bool_()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, edges = [], []
            for t in batch.column(1):
                t = t.as_py()
                found = base_spans(t)
                both = [(*s, True, True) for s in found] + [(a, k, z, False, seed) for a, k, z, seed in loose_spans(t, found)]
                base.append([{"start": a, "kind": k, "end": z} for a, k, z in found])
                edges.append([{"kind": k, "start": a, "end": z, "instance": _instance(t[a:z]), "base": own, "seed": seed, "patterns": p} for (a, k, z, own, seed), p in zip(both, _patterns(t, both))])
            digests = [hashlib.sha256(join_spans([(s["start"], s["kind"], s["end"]) for s in b]).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string()), pa.array(base, span_type), pa.array(edges, edge_type)], ["doc_id", "base_sha256", "base", "edges"])

    return rows.mapInArrow(run, f"doc_id {kind}, base_sha256 string, base array<{_SPAN}>, edges array<{_EDGE}>")


def _marked(patterns: DataFrame) -> np.ndarray:
    """A bitmap with the last ``BITMAP_BITS`` bits of every pattern."""
    word = F.shiftright(F.col("pattern").bitwiseAND((1 << BITMAP_BITS) - 1), 6).alias("w")
    found = patterns.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(pattern & 63 as int))")).alias("b")).toArrow()  # 1 << (BITMAP_BITS - 6) rows at most
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out


def _count_patterns(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``pattern, total``: the places in all texts at which a wanted pattern stands."""
    shared = docs.sparkSession.sparkContext.broadcast(_marked(wanted))  # 1 << BITMAP_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            held = []
            for t in batch.column(0):
                h = _hashes(_TOKEN.findall(t.as_py() or ""))
                for p in _all_patterns(h):
                    at = (p & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
                    held.append(p[(bits[at >> 6] >> (at & 63)) & 1 == 1])
            found, n = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["pattern", "n"])

    counted = docs.select(F.col(text).cast("string")).mapInArrow(run, "pattern long, n long")
    return counted.groupBy("pattern").agg(F.sum("n").alias("total")).join(wanted, "pattern", "left_semi")


def score_patterns(edges: DataFrame, totals: DataFrame, min_seeds: int = 3, min_confidence: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(``kind, pattern, confidence`` of eligible patterns, ``kind, instance`` believed by a trusted one).

    ``edges``: ``kind, pattern, instance, seed, n``; ``totals``: ``pattern, total``. Scores only grow from round to round.
    Rounds end when the sets of eligible and trusted patterns and of believed instances are those of the round before and
    all scores together have grown by less than ``STILL``; more than ``MOST_ROUNDS`` are an error, not a result.
    """
    edges = durable(edges.join(totals, "pattern"))
    scores = durable(edges.groupBy("kind", "instance").agg(F.max("seed").cast("double").alias("score")))
    name = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)"))
    before, grown = None, 0.0
    for _ in range(MOST_ROUNDS):
        gain = F.sum(F.col("score") * F.col("n")) / F.greatest(F.first("total"), F.sum("n"))
        believed = F.count(F.when(F.col("score") >= min_confidence, 1))
        found = edges.join(scores, ["kind", "instance"]).groupBy("kind", "pattern").agg(gain.alias("confidence"), believed.alias("_n"))
        confidence = durable(found.where(F.col("_n") >= min_seeds).drop("_n"))
        doubt = F.sum(F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.999))))
        behind = edges.join(confidence, ["kind", "pattern"], "left").groupBy("kind", "instance")
        scores = durable(behind.agg(F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(doubt)).alias("score"), F.max("confidence").alias("best")))
        patterns = confidence.agg(F.count("*"), name("kind", "pattern", F.col("confidence") >= min_confidence)).first()
        instances = scores.agg(name("kind", "instance", F.col("score") >= min_confidence), F.coalesce(F.sum("score"), F.lit(0.0))).first()
        state = (*patterns, instances[0])
        if state == before and abs(instances[1] - grown) < STILL:
            break
        before, grown = state, instances[1]
    else:
        raise RuntimeError(f"patterns are not settled after {MOST_ROUNDS} rounds")
    return confidence, scores.where(F.col("best") >= min_confidence).select("kind", "instance")


def extract(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_seeds: int = 3, min_confidence: float = 0.5) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``: base counts and all spans."""
    found = durable(_extract(docs, key, text).withColumn("_rid", F.monotonically_increasing_id()))
    spread = found.select("_rid", F.explode("edges").alias("e")).select("_rid", "e.*")
    edges = spread.withColumn("pattern", F.explode("patterns")).groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"), F.max("base").alias("base"), F.count("*").alias("n"))
    # No pattern with fewer instances, or with nothing to add behind it and nothing to learn from, can matter.
    able = edges.groupBy("kind", "pattern").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_seeds).select("kind", "pattern")
    edges = durable(edges.join(able, ["kind", "pattern"], "left_semi"))
    label = F.array(*[F.lit(k) for k in KINDS])
    spans, joined = F.col("base"), found
    if not edges.where("not base").isEmpty():
        totals = durable(_count_patterns(docs, text, edges.select("pattern").distinct()))
        _, believed = score_patterns(edges.drop("base"), totals, min_seeds, min_confidence)
        new = spread.where("not base").join(believed, ["kind", "instance"], "left_semi")
        ordered = F.array_sort(F.collect_set(F.struct("start", (-F.col("end")).alias("minus"), "kind")))
        none = F.array().cast(f"array<{_SPAN}>")
        step = lambda held, s: F.when(
            (F.size(held) == 0) | (F.element_at(held, -1)["end"] <= s["start"]),
            F.concat(held, F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), (-s["minus"]).alias("end")))),
        ).otherwise(held)
        chosen = new.groupBy("_rid").agg(ordered.alias("_all")).select("_rid", F.aggregate("_all", none, step).alias("added"))
        joined = found.join(chosen, "_rid", "left")
        spans = F.array_sort(F.concat("base", F.coalesce("added", none)))
    named = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(label, s["kind"]), s["start"], s["end"])), ",")
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, F.lit(i)))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return joined.select("doc_id", *counts, "base_sha256", named.alias("spans"), (F.size(spans) - F.size("base")).cast("long").alias("n_added"))
