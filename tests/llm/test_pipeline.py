from __future__ import annotations

import corpus_pipeline
from corpusloom.llm import bpe, linedup, mixing, quality, simhash
from corpusloom.llm.common import read_table
from corpusloom.llm.queries import VOCABULARY

from .data import docs, empty, rows

SF = "/root/testdata/sf0.001"


def stored(spark, tmp_path, frame, labels):
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_awkward_rows_pass_every_stage(spark, tmp_path):
    """Null and empty texts, null and repeated ids, repeated rows, a very long text, clashing column names."""
    where = stored(spark, tmp_path, docs(spark), [(i, 1, 0) for i in range(0, 60, 2)] + [(None, 0, 0)])
    seen = read_table(spark, where, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, where)
        assert seen.columns == docs(spark).columns and seen.dtypes == docs(spark).dtypes, name
    got = corpus_pipeline.run(spark, where)
    assert {r.doc_id for r in got.collect()} <= {r[0] for r in rows()} and got.where("n_tokens is null or ids_sha256 is null").isEmpty()
    # With labels of one class nothing is rejected, so what is left of a null text is one empty document at most.
    assert got.where("n_tokens = 0").select("doc_id").distinct().count() <= 1 and not got.isEmpty()


def test_an_empty_table_passes_every_stage(spark, tmp_path):
    where = stored(spark, tmp_path, empty(spark), [])
    assert corpus_pipeline.run(spark, where).count() == 0


def test_stages_are_the_operators_in_order(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "mixing", "bpe"]
    direct = quality.keep_quality(docs, read_table(spark, SF, "labels"))
    direct = linedup.dedup_documents(direct)
    direct = simhash.drop_near_duplicates(direct)
    direct = mixing.mix_documents(direct)
    assert direct.columns == columns
    direct = bpe.encode(direct, VOCABULARY, outputs=("n_tokens", "ids_sha256"))
    run = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, direct.collect()))


def test_clean_documents_pass_the_first_stage(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    kept = {r.doc_id for r in corpus_pipeline.keep_good(spark, docs, SF).collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert good <= kept and not bad & kept


def test_near_copies_are_gone_after_the_third(spark):
    docs = corpus_pipeline.drop_near_copies(spark, read_table(spark, SF, "documents"), SF)
    again = simhash.near_duplicates(docs)
    assert again.where("doc_id <> component_id").isEmpty()
