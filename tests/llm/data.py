"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _s string, _h int, shard int, fp string, lines int, component_id int"
LETTERS = "etaoinshrdlu"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 7))) for _ in range(n)).capitalize() + "."


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    shared = sentence(rng, 60)
    copies = sentence(rng, 90) + "\n" + sentence(rng, 40)
    for i in range(n):
        text = "\n".join(sentence(rng, rng.randint(1, 70)) for _ in range(rng.randint(1, 4)))
        if i % 7 == 0:
            text = text + "\n" + shared
        if i % 3 == 0:
            text = copies
        if i % 10 == 9:
            text = copies.replace(" ", "  ", 1).replace(copies[-9:], "changed.")
        out.append((i, text, rng.choice(["en", "de", None]), "hot" if i % 3 == 0 else f"s{i % 4}"))
    out += [(100, None, None, None), (101, "", "en", "s1"), (102, " \n \t\n", "de", ""), (103, "one", "en", "s2"), (None, "null id text", "en", "s0"), (104, "é ß 😀 <|endoftext|> x", "fr", "s3")]
    out += [(105, "long " * 60_000 + "end", "en", "hot"), (7, out[7][1], "en", "s3"), (7, out[7][1], "en", "s3"), (7, "another text of seven", "en", "s1")]
    return [(*r, 1, "x", 2, 3, "y", 4, 5) for r in out]


def docs(spark, n: int = 60):
    return spark.createDataFrame(rows(n=n), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
