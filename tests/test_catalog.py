"""Every registered query of the library against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__
from corpusloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "conversations", "events", "labels", "benchmark")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, duck, name):
    mine = catalog.QUERIES[name](spark, SF)
    theirs = duck.execute(catalog.SQL[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(mine.columns)
    assert comparable(mine.collect(), mine.columns) == comparable(theirs.fetchall(), names)


def test_entry_has_rows(spark):
    frame = __spark_entry__.entry(spark)
    assert frame.count() == 200 and "errors" in frame.columns


def test_queries_without_sql_return_rows(spark):
    for name in sorted(set(catalog.QUERIES) - set(catalog.SQL)):
        assert not catalog.QUERIES[name](spark, SF).isEmpty(), name


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_lookup_batches_ask_the_whole_index(spark, tmp_path):
    """An id is known only if a record with a complete abstract holds it, whatever its venue."""
    long = "A title of a made document\n" + "Words of a complete abstract. " * 10
    rows = [(10, long), (11, "short"), (13, long), (14, long), (20, "short"), (22, "short"), (30, "short")]
    spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.archive: (r.seq, r.batch) for r in catalog.lookup_batches(spark, str(tmp_path)).collect()}
    # 10 names an archive id by its DOI; 20 and 22 share one that no complete record has; 10 is one for 11.
    assert got == {"10": (10, 0), "2400.00003": (20, 0)}


def test_clean_abstracts_of_odd_pages_equal_their_sql(spark, tmp_path):
    """Broken and rare entities, white space beyond ASCII's, and pages that break off."""
    words = "Words of a complete abstract. " * 4
    ends = ["&quot", "&quo", "&copy", "&middot", "&amp", "&am", "&a", "&amp;quot;", "&amp;amp;", "&lt;b&gt;", "&nbsp;", "&#39;", "&quot;", "&copy;x", "&middot;x"]
    ends += ["\u00a0", "\v", "\u2028", "\u2003 ", "\x1c", "\u3000.", "\0", "...", "\u2026", "...\u00a0", "...\u2028", "...\u0085", "...\n", "<p", "<p\n>"]
    heads = ["", "Abstract: ", "<b>ABSTRACT</b>\n- ", "ab\u017ftract ", "\u00a0abstract ", "abstract\v", "\u2003 \u00a0"]
    rows = [(i, "u", h + words + e) for i, (h, e) in enumerate((h, e) for h in heads for e in ends)] + [(900, "u", None), (901, "u", ""), (902, "u", "abstract")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(catalog.SQL["clean_abstracts"]).fetchall()
    got = [tuple(r) for r in catalog.clean_abstracts(spark, str(tmp_path)).select("page_id", "abstract", "complete").collect()]
    assert sorted(got) == sorted(want)
