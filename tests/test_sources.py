from __future__ import annotations

import json
import sys
import types

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import fulltext
from corpusloom.operators.resolution import normalized_index
from corpusloom.schemas import CANDIDATE_COLUMNS
from corpusloom.sources import payloads, pdf, recorded, sinks

ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
<entry><id>http://arxiv.org/abs/2401.00001v2</id><title>A  title
 here</title><summary> An abstract. </summary><published>2024-01-02T00:00:00Z</published><author><name>Jane Doe</name></author><author><name>John Roe</name></author>
<arxiv:comment>Accepted at ICML 2024; 9 pages</arxiv:comment><arxiv:primary_category term="cs.LG"/><category term="cs.LG"/><category term="stat.ML"/>
<link title="pdf" href="http://arxiv.org/pdf/2401.00001v2"/><arxiv:doi>10.1/x</arxiv:doi></entry>
<entry><id>http://arxiv.org/abs/cs/0301001v1</id><title>Second</title><summary>S</summary><published>2003</published><author><name>A</name></author><category term="econ.GN"/></entry></feed>"""

OAI = """<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>
<record><header><identifier>x</identifier></header><metadata><arXiv xmlns="http://arxiv.org/OAI/arXiv/"><id>2401.1</id><created>2024-01-01</created><authors><author><keyname>Doe</keyname><forenames>Jane</forenames></author>
<author><keyname>Roe</keyname></author></authors><title>T one</title><categories>cs.AI q-bio.GN</categories><journal-ref>J. of X</journal-ref><abstract>Abs</abstract></arXiv></metadata></record>
<record><header status="deleted"><identifier>y</identifier></header></record>
<record><header><identifier>z</identifier></header><metadata><arXiv xmlns="http://arxiv.org/OAI/arXiv/"><id></id><title>no id</title></arXiv></metadata></record>
<resumptionToken cursor="0">tok|1001</resumptionToken></ListRecords></OAI-PMH>"""

PUBMED = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID Version="1">77</PMID><Article><ArticleTitle>PT</ArticleTitle><Abstract><AbstractText Label="A">One.</AbstractText><AbstractText Label="B">Two.</AbstractText></Abstract></Article></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pubmed">77</ArticleId><ArticleId IdType="doi">10.1/p</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"""


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_atom(spark, tmp_path):
    rows = payloads.read_atom(spark, write(tmp_path / "a.xml", ATOM)).orderBy("year").collect()
    old, new = rows
    assert tuple(new.asDict()) == CANDIDATE_COLUMNS
    assert (new.title, new.authors, new.year, new.doi, new.arxiv_id) == ("A title here", ["Jane Doe", "John Roe"], 2024, "10.1/x", "2401.00001v2")
    assert (new.venue, new.field, new.keywords) == ("ICML 2024", "Computer Science / Machine Learning", ["cs.LG", "stat.ML"])
    assert (old.arxiv_id, old.venue, old.field, old.pdf_url) == ("0301001v1", "arXiv preprint", "econ.GN", "https://arxiv.org/pdf/0301001v1")


def test_oai(spark, tmp_path):
    path = write(tmp_path / "o.xml", OAI)
    (row,) = payloads.read_oai(spark, path).collect()
    assert (row.arxiv_id, row.title, row.authors, row.year, row.venue, row.field) == ("2401.1", "T one", ["Jane Doe", "Roe"], 2024, "J. of X", "Computer Science / Artificial Intelligence")
    assert row.keywords == ["cs.AI", "q-bio.GN"] and row.citation_count == 0
    assert [r.token for r in payloads.resumption_tokens(spark, path).collect()] == ["tok|1001"]


def test_lookups(spark, tmp_path):
    (p,) = payloads.pubmed_records(spark, write(tmp_path / "p.xml", PUBMED)).collect()
    assert (p.title, p.abstract, p.pmid, p.doi) == ("PT", "One. Two.", "77", "10.1/p")
    work = {"message": {"title": ["CT"], "abstract": "<p>x</p>", "DOI": "10.1/C", "container-title": [], "publisher": "Pub", "subject": ["Sub"]}}
    path = write(tmp_path / "c.json", json.dumps(work))
    (c,) = payloads.crossref_records(spark, path).collect()
    (v,) = payloads.crossref_publications(spark, path).collect()
    assert (c.title, c.doi) == ("CT", "10.1/C") and tuple(v) == ("10.1/c", "Pub", "Sub")
    batch = [{"title": "S", "abstract": "a", "year": 2020, "authors": [{"name": "N"}], "externalIds": {"ArXiv": "1", "DOI": "2", "PubMed": "3"}}, None]
    (s,) = payloads.paper_records(spark, write(tmp_path / "s.json", json.dumps(batch))).collect()
    assert (s.title, s.arxiv_id, s.doi, s.pmid, s.authors, s.year) == ("S", "1", "2", "3", ["N"], "2020")


def test_index_files(spark, tmp_path):
    record = {"title": "T", "abstract": "a" * 90, "doi": "10.1/x", "authors": ["A"], "year": 2020}
    as_map = payloads.read_index(spark, write(tmp_path / "m.json", json.dumps({"doi:10.1/x": record})))
    as_list = payloads.read_index(spark, write(tmp_path / "l.json", json.dumps([record, record])))
    lines = payloads.read_index(spark, write(tmp_path / "l.jsonl", json.dumps(record) + "\n\n"))
    assert (as_map.count(), as_list.count(), lines.count()) == (1, 2, 1)
    assert payloads.read_index(spark, str(tmp_path / "none.json")).count() == 0
    assert payloads.read_index(spark, write(tmp_path / "bad.json", "{broken")).count() == 0
    assert normalized_index(as_map.withColumn("seq", F.lit(1))).first().doi == "10.1/x"


def test_missing_caches_are_empty(spark, tmp_path):
    assert payloads.read_candidates(spark, str(tmp_path / "no.json")).count() == 0
    progress = payloads.read_progress(spark, write(tmp_path / "p.json", json.dumps({"pipeline_version": 7})))
    assert progress.first().searches_done == [] and progress.first().total_collected == 0


def test_files_and_validity(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "good.pdf").write_bytes(b"%PDF-1.4" + b"x" * 3000 + b"%%EOF\n")
    (tmp_path / "d" / "cut.pdf").write_bytes(b"%PDF-1.4" + b"%%EOF" + b"x" * 3000)
    (tmp_path / "d" / "page.pdf").write_bytes(b"  <!DOCTYPE html>" + b"x" * 200)
    files = payloads.read_files(spark, str(tmp_path / "d"))
    got = {r.paper_id: (r.p, r.s) for r in files.select("paper_id", payloads.is_pdf(F.col("content")).alias("p"), payloads.is_source(F.col("content")).alias("s")).collect()}
    assert got == {"good": (True, True), "cut": (False, True), "page": (False, False)}
    parsed = pdf.parse_pdfs(files, "pdfplumber").collect()
    assert len(parsed) == 3 and all(r.full_text is None and len(r.parse_errors) == 1 for r in parsed)


def test_identifier_helpers(spark):
    row = spark.range(1).select(payloads.source_file(F.lit("2401.1")).alias("f"), payloads.id_variants(F.lit("2401.1v2")).alias("v"), payloads.pdf_link(F.lit("<a href='x/y.pdf?z'>")).alias("l")).first()
    assert row.f.startswith("arxiv_") and len(row.f) == 26 and row.v == ["2401.1v2", "2401.1"] and row.l == "x/y.pdf?z"
    rows = spark.createDataFrame([("PMID: 5", None), (None, "7"), ("6", None)], "pmid string, pmcid string")
    known = spark.createDataFrame([("5", "pmc9")], "pmid string, pmcid string")
    assert sorted((r.pmid or "", r.pmcid) for r in payloads.with_pmcid(rows, known).collect()) == [("", "PMC7"), ("6", None), ("PMID: 5", "PMC9")]
    assert payloads.search_query("q", ["a", "b"]) == "(q) AND (cat:a OR cat:b)" and payloads.venue_query("V", 2020) == '"V" AND 2020'


def test_cascade_takes_the_first_source_that_parses(spark):
    good = b"\\documentclass{a}\\begin{document}\\section{Method}" + b"Words here. " * 40 + b"\\end{document}"
    jats = b"<article><body><sec><title>Method</title><p>" + b"words " * 60 + b"</p></sec></body></article>"
    make = lambda rows: spark.createDataFrame(rows, "paper_id string, content binary")
    out = fulltext.parse_cascade([("tex", make([("a", good), ("b", b"short")]), "tex"), ("jats", make([("a", jats), ("b", jats), ("c", b"<x")]), "jats")])
    got = {r.paper_id: (r.source, r.errors) for r in out.collect()}
    assert got["a"] == ("tex", None) and got["b"][0] == "jats" and got["b"][1][0].startswith("tex: ") and got["c"][0] is None


def test_recorded_source(spark, tmp_path):
    (tmp_path / "r").mkdir()
    write(tmp_path / "r" / "1.jsonl", '{"title": "A", "year": 2020}\n{"title": "B"}\n')
    spark.dataSource.register(recorded.RecordedSource)
    rows = spark.read.format("recorded").option("path", str(tmp_path / "r")).option("schema", "title string, year int").load()
    assert sorted(map(tuple, rows.collect())) == [("A", 2020), ("B", None)]


def test_config(tmp_path):
    assert payloads.read_config(write(tmp_path / "c.json", '{"a": 1}')) == {"a": 1}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("p/1", "T", "a", [], []), ("p2", "U", "b", [], ["title is empty"])], "paper_id string, title string, abstract string, references array<string>, errors array<string>")
    for c in ("introduction", "field", "venue", "method"):
        rows = rows.withColumn(c, F.lit("x"))
    sinks.write_documents(rows.withColumn("year", F.lit(None).cast("int")), str(tmp_path / "out"))
    good = spark.read.json(str(tmp_path / "out/documents")).collect()
    bad = spark.read.json(str(tmp_path / "out/_rejected")).collect()
    assert [r.file for r in good] == ["p_1"] and [r.errors for r in bad] == [["title is empty"]]
    results = spark.createDataFrame([("T", ["A"], 2020, "f", "v", {"method": "m", "x": "y"}, "d", "i", "abs", 1), ("U", [], None, None, None, None, None, None, None, None)], "title string, authors array<string>, year int, field string, venue string, sections map<string,string>, doi string, arxiv_id string, abstract string, citation_count int")
    sinks.export_corpus(results, str(tmp_path / "corpus"), ["method"])
    (line,) = spark.read.json(str(tmp_path / "corpus")).collect()
    assert line.sections.asDict() == {"method": "m"}
    assert sinks.section_texts(results, "method").collect()[0].text == "m"
    assert sinks.result_rows(results).first().file.endswith(".json")
    with pytest.raises(Exception):
        sinks.section_texts(results, "method").select("nope").collect()


def test_pdf_backends_are_assembled(monkeypatch):
    """With stand-ins for the two libraries, which are not installed here; the real ones are untested."""

    class Opened(list):
        metadata = {"title": "A title", "producer": None}
        __enter__ = lambda self: self
        __exit__ = lambda self, *error: None
        pages = property(lambda self: self)

    span = lambda t: {"text": t}
    blocks = [{"type": 0, "bbox": (0, 1, 2, 3), "lines": [{"spans": [span("A"), span("head")]}, {"spans": [span("line")]}]}, {"type": 1, "bbox": (4, 5, 6, 7), "size": 9}]
    page = types.SimpleNamespace(get_text=lambda kind="text": {"blocks": blocks} if kind == "dict" else "A head line", extract_text=lambda: None, extract_tables=lambda: [[["a", "b"]]])
    asked = []
    monkeypatch.setitem(sys.modules, "fitz", types.SimpleNamespace(open=lambda stream, filetype: asked.append((stream, filetype)) or Opened([page, page])))
    monkeypatch.setitem(sys.modules, "pdfplumber", types.SimpleNamespace(open=lambda f: asked.append(f.read()) or Opened([page])))
    first = pdf._mupdf(b"%PDF")
    assert [p["page_num"] for p in first["pages"]] == [1, 2] and first["metadata"] == {"title": "A title"}
    assert first["pages"][0]["blocks"] == [{"type": "text", "bbox": [0, 1, 2, 3], "text": "A head\nline", "size": None}, {"type": "image", "bbox": [4, 5, 6, 7], "text": None, "size": 9}]
    second = pdf._plumber(b"%PDF")
    assert second["pages"] == [{"page_num": 1, "text": "", "blocks": [], "tables": [[["a", "b"]]], "images": []}] and second["metadata"]["title"] == "A title"
    assert asked == [(b"%PDF", "pdf"), b"%PDF"]
