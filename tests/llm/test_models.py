from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest

from corpusloom.llm import langid, pii, quality, topk
from corpusloom.llm.common import read_table

from .data import docs, empty, rows, sentence

SF = "/root/testdata/sf0.001"


def labelled(spark):
    rng = random.Random(2)
    good = [(i, "\n".join(sentence(rng, rng.randint(5, 60)) for _ in range(4)), 1) for i in range(80)]
    bad = [(100 + i, " | ".join(sentence(rng, 1).upper() + "###" for _ in range(60)), 0) for i in range(80)]
    frame = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "quality")


def test_quality_on_held_out_rows(spark):
    texts, labels = labelled(spark)
    got = quality.score_documents(texts, labels).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 20 and all((r.score >= 0.7) == (r.doc_id < 100) == bool(r.predicted) for r in held)


def test_quality_never_sees_held_out_labels(spark):
    texts, labels = labelled(spark)
    stats = quality.document_counts(texts)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end as quality")
    a, b = quality.fit(stats, labels), quality.fit(stats, flipped)
    assert np.array_equal(a.means, b.means) and all(np.array_equal(x, y) for x, y in zip(a.factors, b.factors))


def test_quality_of_awkward_rows(spark):
    texts, labels = labelled(spark)
    model = quality.fit(quality.document_counts(texts), labels)
    scores = quality.score(quality.document_counts(docs(spark)), model).collect()
    assert len(scores) == len(rows()) and all(0 <= r.score <= 1 for r in scores)
    nothing = labels.where("quality = 1")
    assert {r.score for r in quality.score_documents(texts, nothing).collect()} == {1.0}
    assert {r.score for r in quality.score_documents(texts, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_quality(texts, labels)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(80))
    assert quality.keep_quality(empty(spark), labels).count() == 0


def test_mahalanobis_scores_equal_the_densities(spark):
    texts, labels = labelled(spark)
    model = quality.fit(quality.document_counts(texts), labels)
    found = np.array([quality.counts(r[1]) for r in rows(n=10)[:10]])
    x = quality.transform(found, model.rates, model.smoothing)
    logs = []
    for mean, factor, prior in zip(model.means, model.factors, model.log_prior):
        s = factor @ factor.T
        logs.append([prior - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * (v - mean) @ np.linalg.inv(s) @ (v - mean) for v in x])
    want = 1 / (1 + np.exp(np.clip(np.array(logs[0]) - np.array(logs[1]), -700, 700)))
    assert np.allclose(model.score(found), want, atol=1e-6)


def plain_quality(found: np.ndarray, y: np.ndarray, smoothing: float):
    """Rates, means and covariances straight from the definition, on raw rows."""
    of = {n: found[:, i].sum() for i, n in enumerate(quality.COUNTS)}
    rates = np.array([*[(of[h] + 0.5) / (of[t] + 1) for h, t in quality.STATISTICS], of["visible"] / of["words"]])
    x = quality.transform(found, rates, smoothing)
    own = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    pooled = ((y == 0).sum() * own[0] + (y == 1).sum() * own[1]) / len(y)
    out = []
    for c in (0, 1):
        s = 0.9 * own[c] + 0.1 * pooled
        out.append((x[y == c].mean(axis=0), 0.95 * s + 0.05 * np.diag(np.diag(s)) + 1e-4 * np.eye(len(s)), np.log((y == c).mean())))
    return rates, out


def plain_score(found: np.ndarray, model, smoothing: float) -> np.ndarray:
    rates, classes = model
    x = quality.transform(found, rates, smoothing)
    logs = [prior - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m) for m, s, prior in classes]
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def test_quality_fit_is_that_of_numpy(spark):
    rng = random.Random(7)
    mixed = lambda bad: " ".join(sentence(rng, 1) + ("###" if rng.random() < bad else "") for _ in range(rng.randint(3, 60)))
    data = [(i, mixed(0.25 if i % 2 else 0.05), 1 - i % 2) for i in range(240)]
    frame = spark.createDataFrame(data, "doc_id long, text string, quality int")
    model = quality.fit(quality.document_counts(frame), frame)
    fold = np.array([zlib.crc32(str(i).encode()) % 4 for i, *_ in data])
    found, y = np.array([quality.counts(t) for _, t, _ in data]), np.array([q for *_, q in data])
    learn = fold != 2
    losses = []
    for s in quality.SMOOTHINGS:
        p = np.empty(len(y))
        for f in (0, 1, 3):
            p[fold == f] = plain_score(found[fold == f], plain_quality(found[learn & (fold != f)], y[learn & (fold != f)], s), s)
        wrong, right = (p >= 0.7) != (y == 1), np.clip(np.where(y == 1, p, 1 - p), 1e-12, 1)
        losses.append((round(sum(wrong[learn & (y == c)].mean() for c in (0, 1)), 9), sum(-np.log(right[learn & (y == c)]).mean() for c in (0, 1)), s))
    assert len({x[:2] for x in losses}) > 1 and model.smoothing == min(losses)[2]
    want = plain_quality(found[learn], y[learn], model.smoothing)
    for mean, factor, prior, (m, s, p) in zip(model.means, model.factors, model.log_prior, want[1]):
        assert np.allclose(mean, m) and np.allclose(factor @ factor.T, s) and np.isclose(prior, p)
    assert np.allclose(model.score(found), plain_score(found, want, model.smoothing), atol=1e-7)


def test_quality_labels_that_repeat_or_are_odd(spark):
    texts, labels = labelled(spark)
    odd = labels.unionByName(labels.where("doc_id < 100")).unionByName(spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int"))
    model = quality.fit(quality.document_counts(texts), odd, smoothing=40.0)
    kept = [zlib.crc32(str(i).encode()) % 4 != 2 for i in range(180)]
    good, bad = 2 * sum(kept[:80]), sum(kept[100:])
    assert np.allclose(np.exp(model.log_prior), [bad / (good + bad), good / (good + bad)])
    same = quality.keep_quality(texts.selectExpr("doc_id", "text as body", "doc_id as counts"), labels, text="body")
    assert same.columns == ["doc_id", "body", "counts"] and same.count() == 80


def plain_top(vectors, k, every):
    ok = [(i, np.floor(64 * np.array(v, np.float64))) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in ok:
        if q % every == 0:
            scored = sorted((-int(sum(int(x) * int(y) for x, y in zip(a, b))), i) for i, b in ok if i != q and len(a) == len(b))
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)}
    return out


@pytest.mark.parametrize("tile", [2048, 3])
def test_topk_is_exact(spark, monkeypatch, tile):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    vectors = [(i, [rng.choice([-1.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(70)]
    vectors += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.0] * 4), (205, [1.0, 2.0]), (206, [1.0, 3.0]), (210, [])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(7)
    if tile < 10:  # many cells, and a tree of several levels
        for name, n in (("TILE_ROWS", tile), ("CELL_QUERIES", 4), ("CELL_ROWS", 8), ("FAN_IN", 2)):
            monkeypatch.setattr(topk, name, n)
    got = {tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 5 == 0, 6).collect()}
    assert got == plain_top(vectors, 6, 5)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_topk_of_repeated_rows_and_clashing_names(spark):
    from pyspark.sql import functions as F

    vectors = [(5, [1.0, 0.0]), (5, [0.5, 0.0]), (6, [1.0, 1.0]), (6, [1.0, 1.0]), (7, [1.0, -1.0])]
    frame = spark.createDataFrame([(*v, 1, 2, 3, 4) for v in vectors], "vec_id long, embedding array<double>, block int, asks int, dim int, v int")
    got = sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") == 5, 3).collect())
    assert got == sorted([(5, n, i, s) for n, i, s in ((1, 6, 4096), (2, 6, 4096), (3, 7, 4096))] + [(5, n, i, s) for n, i, s in ((1, 6, 2048), (2, 6, 2048), (3, 7, 2048))])


def test_topk_of_huge_components():
    q, c = np.array([[2.0**40, 3.0]]), np.array([[2.0**40, 1.0], [5.0, 2.0], [2.0**40, 1.0]])
    scores, ids = topk._best_of_tile(np.array([9]), q, np.array([1, 2, 3]), c, 2)
    assert ids.tolist() == [[1, 3]] and scores[0][0] == topk.MOST


def test_languages_on_held_out_rows(spark):
    found = langid.identify(read_table(spark, SF, "documents")).collect()
    truth = {r.doc_id: r.lang for r in read_table(spark, SF, "documents").collect()}
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 20 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_of_awkward_rows(spark):
    model = langid.fit(read_table(spark, SF, "documents"))
    got = {r.doc_id: r for r in langid.predict(docs(spark), model).collect()}
    assert {got[i].lang_pred for i in (100, 101, 102)} == {"und"} and got[100].score == 0
    assert got[103].lang_pred in model.languages and langid.predict(docs(spark), model).count() == len(rows())
    assert langid.fit(docs(spark).where("lang is null")) is None and langid.fit(empty(spark)) is None
    assert {r.lang_pred for r in langid.predict(docs(spark), None).collect()} == {"und"}


@pytest.mark.parametrize("text", ["\U0001D11E", "\U0001D7CE", "\U000E0041", "\U0001F600 12 !", "\ud800"])
def test_texts_without_a_letter_have_no_features(text):
    assert langid.features(text) is None and not any(map(str.isalpha, text))


def test_letters_beyond_the_first_plane_count():
    assert all(langid.features(t) is not None for t in ("\U00020000", "\U00010400", "a\U0001F600"))


def test_predictions_are_the_votes_taken_one_by_one(spark):
    model = langid.fit(read_table(spark, SF, "documents"))
    assert max(map(len, model.members.values())) > 1
    rng = random.Random(2)
    x = np.array([v for v in (langid.features(" ".join(sentence(rng, 3) for _ in range(rng.randint(1, 4)))) for _ in range(80))])
    x = np.vstack([x, [langid.features(r.text) for r in read_table(spark, SF, "documents").where("text is not null").limit(60).collect() if langid.features(r.text) is not None]])
    names, scores = model.predict(x)
    sure = lambda m: 1 / (1 + math.exp(-model.sharpness * m))
    for v, name, score in zip(x, names, scores):
        margins = [float(w @ v + b) for w, b in zip(*model.family_machines)]
        f = max(range(len(margins)), key=margins.__getitem__)
        own = model.members[model.families[f]]
        votes, sums = [0.0] * len(own), [0.0] * len(own)
        for a, b, w, bias in model.pairs[model.families[f]]:
            m = float(w @ v + bias)
            votes[a if m > 0 else b] += 1
            sums[a] += sure(m) / (len(own) - 1)
            sums[b] += sure(-m) / (len(own) - 1)
        best = max(range(len(own)), key=lambda i: votes[i] + sums[i] / (len(own) + 1))
        assert name == model.languages[own[best]]
        assert abs(score - sure(margins[f]) * (sums[best] if len(own) > 1 else 1)) < 1e-5


def test_most_languages_bounds_the_fit(spark):
    known = read_table(spark, SF, "documents")
    model = langid.fit(known, most_languages=2)
    sizes = {r.lang: r["count"] for r in known.where("lang is not null and text is not null and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").groupBy("lang").count().collect()}
    assert set(model.languages) == set(sorted(sizes, key=lambda k: (-sizes[k], k))[:2])


def test_long_texts_give_the_same_features(monkeypatch):
    text = "Äöü abc déf. " * 50
    whole = langid.features(text)
    monkeypatch.setattr(langid, "_PIECE", 37)
    assert np.allclose(langid.features(text), whole)


BASE = [
    ("mail a.b@mail.example.com now", "email:5:25"),
    ("x@@y.com a@b.c@d.e", "email:9:14"),
    ("1.2.3.4 and 1.2.3.456 and 1.2.3.4.5.6.7.8", "ip:0:7,ip:26:33,ip:34:41"),
    ("card 4111 1111-1111 1111 and 4111111111111112", "card:5:24"),
    ("call +1 (724) 555-7058, +12 3", "phone:5:22"),
    ("😀 +1 (724) 555-7058", "phone:2:19"),
    ("9" * 5000 + "." + "1", ""),
    ("", ""),
]


@pytest.mark.parametrize("text, spans", BASE)
def test_base_spans(text, spans):
    import re

    assert pii.join_spans(pii.base_spans(text)) == spans
    plain = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        plain.append((m.start(), 0, m.end()))
    if len(text) < 1000:
        assert [s for s in pii.base_spans(text) if s[1] == 0] == plain


def plain_base(text: str) -> list[tuple[int, int, int]]:
    """The contract's patterns and tests, taken literally."""
    out = []
    for kind, shape in enumerate((
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )):
        for m in re.finditer(shape, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits))]
            ok = (True, all(int(x) <= 255 for x in m[0].split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0, 10 <= len(digits) <= 15)[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_are_the_patterns():
    rng = random.Random(3)
    some = ["a.b@c.de", "@", "x@y", "+1 (202) 555-0143", "+", "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.1", "256.1.1.1", "1.2.3.4.5", "007.8.9.10", ".", " ", "-", "é", "12", "(", "5500005555555559", "00"]
    hits = 0
    for _ in range(3000):
        text = "".join(rng.choice(some) + rng.choice(["", "", " ", "\n"]) for _ in range(rng.randint(1, 12)))
        assert pii.base_spans(text) == plain_base(text), text
        hits += len(plain_base(text))
    for r in duckdb.sql(f"select text from read_parquet('{SF}/documents.parquet') where text is not null").fetchall():
        assert pii.base_spans(r[0]) == plain_base(r[0])
    assert hits > 1000


def test_patterns_are_the_same_at_a_span_and_in_a_count():
    text = "Say token = \"ab12cd34\", and pay."
    span = (text.index("ab12"), 4, text.index("ab12") + 8)
    everywhere = pii._all_patterns(pii._tokens(text)[0])
    assert len(pii._patterns(text, [span])[0]) == 4
    counts = [(places.view(np.int64) == one).sum() for one, places in zip(pii._patterns(text, [span])[0], everywhere)]
    assert counts == [2, 1, 1, 1]  # the quote stands twice


def plain_scores(edges: list[tuple], total: dict, least: int = 3, sure: float = 0.5):
    """Rounds over patterns and instances in plain Python."""
    seeds = {i for _, i, seed, _ in edges if seed}
    score, before = {i: float(i in seeds) for _, i, *_ in edges}, None
    while True:
        confidence = {}
        for p in total:
            mine = [(i, n) for q, i, _, n in edges if q == p]
            if sum(score[i] >= sure for i, _ in mine) >= least:
                confidence[p] = sum(score[i] * n for i, n in mine) / max(total[p], sum(n for _, n in mine))
        best = {i: max((confidence.get(p, 0) for p, j, *_ in edges if j == i)) for i in score}
        doubt = {i: math.prod(1 - min(confidence.get(p, 0), 0.999) for p, j, *_ in edges if j == i) for i in score}
        score = {i: 1.0 if i in seeds else 1 - doubt[i] for i in score}
        state = ({p: c >= sure for p, c in confidence.items()}, {i for i in score if score[i] >= sure})
        if before and state == before[0] and sum(score.values()) - before[1] < pii.STILL:
            return confidence, {i for i, c in best.items() if c >= sure}
        before = (state, sum(score.values()))


def test_scores_are_those_of_plain_rounds(spark):
    rng = random.Random(5)
    edges = [(1, i, True, 2) for i in range(3)] + [(1, 10, False, 1)]
    edges += [(2, 10, False, 1), (2, 0, True, 1), (2, 1, True, 1), (2, 11, False, 3), (3, 11, False, 1), (3, 12, False, 1)]
    edges += [(p, i, i < 40, rng.randint(1, 3)) for p in range(4, 20) for i in sorted(rng.sample(range(20, 80), 6))]
    total = {p: sum(n for q, _, _, n in edges if q == p) + rng.choice([0, 1, 4, 30]) for p in range(1, 20)} | {1: 8, 2: 6, 3: 2}
    frame = spark.createDataFrame([(0, *e) for e in edges], "kind int, pattern long, instance long, seed boolean, n long")
    confidence, believed = pii.score_patterns(frame, spark.createDataFrame(list(total.items()), "pattern long, total long"))
    want, trusted = plain_scores(edges, total)
    got = {r.pattern: r.confidence for r in confidence.collect()}
    assert set(got) == set(want) and 2 in got and 3 not in got and all(abs(got[p] - want[p]) < 1e-9 for p in got)
    assert {r.instance for r in believed.collect()} == trusted and 10 in trusted and 12 not in trusted


def test_a_chain_of_patterns_is_trusted_to_its_end(spark, monkeypatch):
    """Pattern k is learnt from what pattern k - 1 has found, fourteen times."""
    edges = [(k, 100 * (k + d) + i, k + d == 0, 1) for k in range(14) for d in (0, 1) for i in range(3)]
    frame = spark.createDataFrame([(4, *e) for e in edges], "kind int, pattern long, instance long, seed boolean, n long")
    totals = spark.createDataFrame([(k, 6) for k in range(14)], "pattern long, total long")
    confidence, believed = pii.score_patterns(frame, totals)
    assert confidence.where("confidence >= 0.5").count() == 14 and believed.count() == 45
    monkeypatch.setattr(pii, "MOST_ROUNDS", 8)
    with pytest.raises(RuntimeError):
        pii.score_patterns(frame, totals)


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(1)
    seeds = [(i, f"{sentence(rng, 5)} Hotline: +1 (7{i:02d}) 555-70{i:02d} {sentence(rng, 4)}") for i in range(20)]
    unseen = [(100 + i, f"{sentence(rng, 5)} Hotline: 7{i:02d}-555-11{i:02d} {sentence(rng, 4)}") for i in range(5)]
    # The same numbers behind other words, then numbers that only those words tell of.
    again = [(300 + i, f"{sentence(rng, 5)} desk line 7{i:02d}-555-11{i:02d} {sentence(rng, 4)}") for i in range(5)]
    taught = [(400 + i, f"{sentence(rng, 5)} desk line 6{i:02d}-555-33{i:02d} {sentence(rng, 4)}") for i in range(3)]
    clean = [(200 + i, f"{sentence(rng, 5)} the 7{i:02d}-555-22{i:02d} part {sentence(rng, 4)}") for i in range(5)]
    secret = [(500 + i, f'{sentence(rng, 5)} {" " * i}token = "{hashlib.sha1(bytes([i])).hexdigest()}" {sentence(rng, 4)}') for i in range(6)]
    odd = [(600, f'{sentence(rng, 5)} token = "Zk3_9-qqT/a7" {sentence(rng, 4)}'), (601, f"{sentence(rng, 5)} part Zk3_8-qqT/a7 {sentence(rng, 4)}")]
    frame = spark.createDataFrame(seeds + unseen + again + taught + clean + secret + odd, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.extract(frame).collect()}
    assert all(got[i].n_phone == 1 and got[i].n_added == 0 for i in range(20))
    for ids in (range(100, 105), range(300, 305), range(400, 403)):
        assert all(got[i].n_added == 1 and got[i].n_phone == 0 and got[i].spans.startswith("phone:") for i in ids)
    assert all(got[200 + i].spans == "" for i in range(5))
    assert all(got[500 + i].n_added == 1 and got[500 + i].spans.startswith("secret:") for i in range(6))
    assert got[600].spans.startswith("secret:") and got[601].spans == ""
    text = odd[0][1]
    assert got[600].spans == f"secret:{text.index('Zk3')}:{text.index('Zk3') + 12}"


def test_secrets_of_the_documents_are_found(spark):
    rows_ = read_table(spark, "/root/testdata/sf0.01", "documents").collect()
    got = {r.doc_id: r for r in pii.extract(read_table(spark, "/root/testdata/sf0.01", "documents")).collect()}
    planted = {r.doc_id: len(re.findall('token = "[0-9a-f]{40}"', r.text or "")) for r in rows_}
    assert sum(planted.values()) >= 10 and {i: r.n_added for i, r in got.items()} == planted


def test_a_text_with_many_numbers_is_quick():
    text = " ".join(f"call +1 (202) 555-{i % 10000:04d} or 202-555-{i % 10000:04d}" for i in range(100_000))
    began = time.time()
    base = pii.base_spans(text)
    loose = pii.loose_spans(text, base)
    assert len(base) == 100_000 == len(loose) and len(pii._patterns(text, [*base, *loose])) == 200_000
    assert time.time() - began < 30


def test_pii_of_awkward_rows(spark):
    got = pii.extract(docs(spark))
    assert got.count() == len(rows()) and pii.extract(empty(spark)).count() == 0
    assert {r.base_sha256 for r in got.where("doc_id = 100").collect()} == {"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}
