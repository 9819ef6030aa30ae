"""Scalar cases: each is (function, arguments, expected)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import quality as Q
from corpusloom.functions import text as T

A80 = "x" * 80
CASES = [
    (T.archive_key, ["arXiv:2401.01234v3"], "2401.01234"),
    (T.archive_key, ["https://arxiv.org/abs/2401.01234v2"], "2401.01234"),
    (T.archive_key, ["cs/0301001V1"], "cs/0301001"),
    (T.archive_key, [None], ""),
    (T.doi_key, ["https://doi.org/10.1000/ABC.)"], "10.1000/abc"),
    (T.doi_key, ["DOI: 10.1/X"], "10.1/x"),
    (T.pmid_key, ["PMID: 123"], "123"),
    (T.pmid_key, ["12a"], ""),
    (T.title_key, ["Eﬃcient trans- former"], "efficient transformer"),
    (T.title_key, ["a- b- c"], "abc"),
    (T.clean_space, [" a  b\n"], "a b"),
    (T.clean_space, [None], ""),
    (T.clean_abstract, ["&lt;jats:p&gt;Abstract: We show.&lt;/jats:p&gt;"], "We show."),
    (T.clean_abstract, ["a < b and c > d"], "a d"),
    (Q.abstract_is_complete, ["x" * 79], False),
    (Q.abstract_is_complete, [A80], True),
    (Q.abstract_is_complete, [A80 + "..."], False),
    (Q.abstract_is_complete, [A80 + "…"], False),
    (T.clean_doi, ["doi: 10.1/A%2FB. "], "10.1/A/B"),
    (T.is_archive_doi, ["10.48550/arXiv.2401.1"], True),
    (T.is_archive_doi, ["10.1/a"], False),
    (T.pmcid, ["pmc123"], "PMC123"),
    (T.pmcid, ["PMCx"], None),
    (T.output_stem, ["cs/0301001v1", "10.1/x"], "cs_0301001v1"),
    (T.output_stem, [None, ""], "paper"),
    (T.surname_key, ["Smith, John and Doe, J"], "smith"),
    (T.surname_key, ["Jane O'Neil"], "oneil"),
    (T.surname_key, [""], ""),
    (T.year_of, ["c. 2019"], 2019),
    (T.year_of, ["(2019a)"], None),
    (T.comment_venue, ["Accepted at ICML 2023; 12 pages"], "ICML 2023"),
    (T.comment_venue, ["Published in Foo 2020. Code available"], "Foo 2020"),
    (T.comment_venue, ["12 pages, submitted to ICML"], ""),
    (T.comment_venue, ["published at A, accepted to B"], "B"),
    (T.canonical_section, ["Human Preferences"], "references"),
    (T.canonical_section, ["Introduction to the Model"], "method"),
    (T.canonical_section, ["Results"], "experiments"),
    (T.canonical_section, ["Foo"], None),
    (T.safe_filename, ['a<b>:"c/d'], "a_b___c_d"),
    (T.safe_filename, ["word " * 40], ("word " * 40)[:150].rsplit(" ", 1)[0]),
    (T.reference_identifier, ["T", "2401.1V2", None, None], "arxiv:2401.1v2"),
    (T.reference_identifier, ["T", None, "10.1/A.", "7"], "doi:10.1/a"),
    (T.strip_ending, [" a.;) "], "a"),
    (T.harvest_id, [" 2401.1v3 "], "2401.1v3 ".strip()[:-2]),
    (T.stem_id, ["arXiv:2401.1V3"], "2401.1"),
    (Q.venue_tier, ["Nature Communications", None], 3),
    (Q.venue_tier, ["Naturevision", None], 2),
    (Q.venue_tier, ["arXiv preprint", "10.1/x"], 1),
    (Q.venue_tier, ["arXiv preprint", ""], 0),
    (Q.venue_tier, [None, None], 0),
    (Q.reference_is_noisy, ["Lorem ipsum study", "prose"], True),
    (Q.reference_is_noisy, ["T", "Table 2: x"], True),
    (Q.reference_is_noisy, ["T", "plain prose"], False),
    (Q.is_table_line, ["1 2 3 4 5 6 7 8 a"], True),
    (Q.is_table_line, ["AP AP50 AP75 mAP AUC"], True),
    (Q.is_table_line, ["we use 3 layers"], False),
    (Q.count_of, None, None),
]


@pytest.mark.parametrize("f, args, expected", [c for c in CASES if c[1] is not None], ids=lambda v: getattr(v, "__name__", None) or str(v)[:40])
def test_scalar(spark, f, args, expected):
    row = spark.range(1).select(f(*[F.lit(a).cast("string") for a in args]).alias("x")).first()
    assert row["x"] == expected


def test_category_field(spark):
    c = F.col("c")
    rows = spark.createDataFrame([("cs.AI",), ("econ.GN",), ("physics",), ("",)], "c string").select(T.category_field(c, T.category_label(c)).alias("f")).collect()
    assert [r.f for r in rows] == ["Computer Science / Artificial Intelligence", "econ.GN", "Physics / Physics", "Unknown"]


def test_failure_category(spark):
    rows = spark.createDataFrame([(["introduction is empty or too short"],), (["pdf: unavailable"],)], "e array<string>")
    assert [r.c for r in rows.select(Q.failure_category(F.col("e")).alias("c")).collect()] == ["quality_validation", "source_unavailable"]


def test_lookup_identifiers(spark):
    rows = spark.createDataFrame([("10.1/A.", " u ", "PMID: 3"), ("10.48550/arXiv.1", "u", "u"), (None, None, None)], "d string, u string, p string")
    got = [r.x for r in rows.select(T.lookup_identifiers(F.col("d"), F.col("u"), F.col("p")).alias("x")).collect()]
    assert got == [["10.1/A", "u", "3"], ["u"], []]


GOOD = {"title": "A title", "abstract": "a" * 100, "introduction": "i" * 100, "field": "f", "venue": "v", "method": ""}
CONTEXT = {"source_section": "introduction", "context_before": [], "citation_sentence": "s", "context_after": []}
REF = {"id": "doi:1", "title": "t", "summary": "s" * 80, "citation_contexts": [CONTEXT]}


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, []),
        ({"title": "abcd"}, ["title is empty or too short"]),
        ({"abstract": "a" * 99}, ["abstract is empty or too short"]),
        ({"introduction": "a" * 99}, ["introduction is empty or too short"]),
        ({"field": "", "venue": ""}, ["field is empty", "venue is empty"]),
        ({"references": []}, ["no cited-paper abstracts resolved"]),
        ({"references": [REF] * 4}, ["too few cited-paper abstracts resolved (4 < 5)"]),
        ({"references": [REF] * 4 + [REF | {"citation_contexts": []}]}, ["one or more references lack a complete abstract or citation context"]),
        ({"references": [REF] * 4 + [REF | {"summary": "s" * 79}]}, ["one or more references lack a complete abstract or citation context"]),
        ({"method": "see Table 3"}, ["method contains table/result content"]),
    ],
)
def test_output_gate(spark, change, expected):
    from corpusloom.schemas import RESOLVED

    row = GOOD | {"references": [REF] * 5} | change
    df = spark.createDataFrame([row], f"title string, abstract string, introduction string, field string, venue string, method string, references {RESOLVED}")
    errors = Q.document_errors(*[F.col(c) for c in ("title", "abstract", "introduction", "field", "venue", "method", "references")], min_references=5)
    assert df.select(errors.alias("e")).first()["e"] == expected
