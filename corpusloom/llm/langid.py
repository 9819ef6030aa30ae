"""Language identification in two steps: the family, then the language inside it.

A text is a vector of hashed character n-grams (1 to 3, over lower-case letters with everything else
as a blank), square-rooted and scaled to length one. Linear support vector machines (squared hinge,
one against the rest) choose the language family; in a family with several languages one machine for
every pair of them votes. Machines are fitted in numpy on the driver from a bounded sample.

``per_language`` and ``most_languages`` bound the fit: about that many rows of each language, those with
the smallest seeded hash of id and text, are read, of the languages with the most rows; all other steps
cover every row and the whole text.

The score is the product of the logistic of the family's margin and the mean logistic of the winning
language's margins.

Defined cases: null texts and texts without a letter get ``und`` and score 0, as does every text if no
labelled row can be learned from; one learned language gets every other text; rows repeat as they
stand; an empty table gives none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import seeded_hash

#: Language codes by family; a code that is not here is a family of its own. Fixed values.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "mk", "bg"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indo_aryan": ("hi", "bn", "mr", "gu", "pa", "ur", "ne", "si"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "semitic": ("ar", "he", "mt", "am"),
    "celtic": ("ga", "gd", "cy", "br"),
    "austronesian": ("id", "ms", "tl", "jv", "mg"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
BUCKETS = (512, 1536, 2048)
DIM = sum(BUCKETS)
_PIECE = 1 << 20
_IS_LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(text: str | None) -> np.ndarray | None:
    """The vector of one whole text, or None where it holds no letter."""
    if not text:
        return None
    total = np.zeros(DIM)
    lower, letters = text.lower(), 0
    for low in range(0, len(lower), _PIECE):  # pieces overlap by the two characters an n-gram can reach over
        c = np.frombuffer(lower[max(0, low - 2) : low + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        letter = _IS_LETTER[c.astype(np.int64)]
        letters += int(letter.sum())
        c = np.where(letter, c, 32)
        new = min(2, low)
        two = c[:-1] * np.uint64(0x9E3779B1) + c[1:]
        three = two[:-1] * np.uint64(0x85EBCA6B) + c[2:]
        base = 0
        for grams, width, skip in ((c, BUCKETS[0], new), (two, BUCKETS[1], max(0, new - 1)), (three, BUCKETS[2], 0)):
            mixed = (grams[skip:] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
            total[base : base + width] += np.bincount((mixed % np.uint64(width)).astype(np.int64), minlength=width)
            base += width
    if not letters:
        return None
    total = np.sqrt(total)
    return (total / np.linalg.norm(total)).astype(np.float32)


def _fit_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> tuple[np.ndarray, float]:
    """A linear machine for labels of +1 and -1: squared hinge by Nesterov's accelerated gradient."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    weight = weight / weight.sum()
    step = 1 / (2 * float((weight * (x * x).sum(axis=1)).sum()) + penalty)
    w, ahead, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    for _ in range(steps):
        short = np.maximum(0, 1 - y * (x @ ahead))
        after = ahead - step * (penalty * ahead - 2 * (x.T @ (weight * short * y)))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = after + (before - 1) / t * (after - w), after
    return w[:-1], float(w[-1])


def _balanced(y: np.ndarray) -> np.ndarray:
    return np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    families: tuple[str, ...]
    family_machines: tuple[np.ndarray, np.ndarray]  # weights by family, biases
    pairs: dict[str, list[tuple[int, int, np.ndarray, float]]]
    members: dict[str, list[int]]
    sharpness: float = 4.0

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        sure = lambda m: 1 / (1 + np.exp(-self.sharpness * np.clip(m, -50, 50)))
        margins = x @ self.family_machines[0].T + self.family_machines[1]
        choice = margins.argmax(axis=1)
        score = sure(margins[np.arange(len(x)), choice]) if len(self.families) > 1 else np.ones(len(x))
        chosen = np.zeros(len(x), np.int64)
        for f, family in enumerate(self.families):
            rows = np.flatnonzero(choice == f)
            own = self.members[family]
            if len(own) == 1 or not len(rows):
                chosen[rows] = own[0]
                continue
            votes, sums = np.zeros((len(rows), len(own))), np.zeros((len(rows), len(own)))
            for a, b, w, bias in self.pairs[family]:
                m = x[rows] @ w + bias
                for side, margin in ((a, m), (b, -m)):
                    votes[:, side] += margin > 0
                    sums[:, side] += sure(margin) / (len(own) - 1)
            best = (votes + sums / (len(own) + 1)).argmax(axis=1)
            chosen[rows] = np.array(own)[best]
            score[rows] *= sums[np.arange(len(rows)), best]
        return [self.languages[i] for i in chosen], np.clip(score, 0, 1)


def _feature_rows(docs: DataFrame, columns: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if v is None else v.tobytes() for v in x], pa.binary())], ["lang", "x"])

    return docs.mapInArrow(run, columns)


def fit(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", modulus: int = 5, held_out: int = 0, per_language: int = 500, most_languages: int = 256, seed: int = 5) -> LanguageModel | None:
    """Fit on about ``per_language`` rows of each of the ``most_languages`` largest languages, outside the held-out remainder."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.crc32(F.col(key).cast("string").cast("binary")) % modulus != held_out))
    largest = known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    sizes = {r["lang"]: r["n"] for r in largest.collect()}
    if not sizes:
        return None
    limit = F.create_map(*[v for name, n in sizes.items() for v in (F.lit(name), F.lit(int(min(1.0, per_language / n) * (1 << 60))))])
    own = seeded_hash(seed, F.concat_ws(":", F.col(key).cast("string"), F.md5(text)))
    taken = known.where(own <= limit[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = _feature_rows(taken, "lang string, x binary").where("x is not null").collect()  # bounded by per_language
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    if not rows:
        return None
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows])
    names = np.array([r["lang"] for r in rows])
    languages = tuple(sorted(set(names.tolist())))
    family_of = {code: FAMILY_OF.get(code, code) for code in languages}
    families = tuple(sorted(set(family_of.values())))
    members = {f: [i for i, code in enumerate(languages) if family_of[code] == f] for f in families}
    of_row = np.array([family_of[n] for n in names.tolist()])
    machines = []
    for f in families if len(families) > 1 else ():
        y = np.where(of_row == f, 1.0, -1.0)
        machines.append(_fit_machine(x, y, _balanced(y)))
    weights = (np.array([w for w, _ in machines]), np.array([b for _, b in machines])) if machines else (np.zeros((1, DIM)), np.zeros(1))
    pairs: dict[str, list] = {f: [] for f in families}
    for f in families:
        for a, b in itertools.combinations(range(len(members[f])), 2):
            one, two = languages[members[f][a]], languages[members[f][b]]
            mine = (names == one) | (names == two)
            y = np.where(names[mine] == one, 1.0, -1.0)
            pairs[f].append((a, b, *_fit_machine(x[mine], y, _balanced(y))))
    return LanguageModel(languages, families, weights, pairs, members)


def predict(docs: DataFrame, model: LanguageModel | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some vectors for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            texts = batch.column(1)
            for low in range(0, batch.num_rows, 1024):
                found = [(low + i, v) for i, t in enumerate(texts.slice(low, 1024)) if (v := features(t.as_py())) is not None]
                if found and model is not None:
                    at = [i for i, _ in found]
                    best, scores[at] = model.predict(np.array([v for _, v in found]))
                    for i, name in zip(at, best):
                        names[i] = name
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and predict all of them."""
    return predict(docs, fit(docs, **options))
