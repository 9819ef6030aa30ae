"""The driver's tables as scholarly records: the same rows in DataFrame and SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import spread

VENUES = ("Nature", "NeurIPS", "Journal of Made Results", "arXiv preprint", "arXiv (Machine Learning)", "", "Nature Communications", "Naturevision", "Unknown")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate records from ``documents``; the first line is the title, ids repeat by design."""
    d = table(spark, sf_dir, "documents").where("doc_id is not null")
    venues = ", ".join(f"'{v}'" for v in VENUES)
    return d.selectExpr(
        "doc_id as seq",
        "split_part(text, '\\n', 1) as title",
        "array(concat('Author ', doc_id % 17, ', A.'), concat('Second ', doc_id % 5)) as authors",
        "cast(2015 + doc_id % 12 as int) as year",
        "case when doc_id % 4 = 0 then concat('10.1234/', source, '.', doc_id div 40) when doc_id % 9 = 1 then concat('10.48550/arXiv.', doc_id) end as doi",
        "case when doc_id % 5 = 0 then concat('PMID: ', 100000 + doc_id % 300) end as pmid",
        "case when doc_id % 11 = 0 then concat('pmc', doc_id) end as pmcid",
        "case when doc_id % 3 <> 0 then concat('2400.', lpad(cast(doc_id div 6 as string), 5, '0'), 'v', 1 + doc_id % 3) end as arxiv_id",
        "case when doc_id % 6 = 0 then 'Unknown' when doc_id % 6 = 1 then concat('Field ', lang) end as field",
        f"element_at(array({venues}), cast(doc_id % {len(VENUES)} as int) + 1) as venue",
        "text as abstract",
        "concat('https://example.org/', doc_id) as url",
        "case when doc_id % 7 = 0 then concat(' https://publisher.example/', doc_id, ' ') end as publisher_url",
        "case when doc_id % 3 = 1 then concat('https://example.org/', doc_id, '.pdf') end as pdf_url",
        "source",
        "array(case when doc_id % 2 = 0 then 'cs.LG' else 'q-bio.GN' end, lang) as keywords",
        "cast(n_chars % 1000 as int) as citation_count",
    )


CAND_SQL = f"""cand as (
  select doc_id as seq, split_part(text, chr(10), 1) as title,
    ['Author ' || (doc_id % 17) || ', A.', 'Second ' || (doc_id % 5)] as authors, cast(2015 + doc_id % 12 as int) as year,
    case when doc_id % 4 = 0 then '10.1234/' || source || '.' || (doc_id // 40) when doc_id % 9 = 1 then '10.48550/arXiv.' || doc_id end as doi,
    case when doc_id % 5 = 0 then 'PMID: ' || (100000 + doc_id % 300) end as pmid,
    case when doc_id % 11 = 0 then 'pmc' || doc_id end as pmcid,
    case when doc_id % 3 <> 0 then '2400.' || lpad((doc_id // 6)::varchar, 5, '0') || 'v' || (1 + doc_id % 3) end as arxiv_id,
    case when doc_id % 6 = 0 then 'Unknown' when doc_id % 6 = 1 then 'Field ' || lang end as field,
    [{", ".join(f"'{v}'" for v in VENUES)}][1 + doc_id % {len(VENUES)}] as venue, text as abstract,
    case when doc_id % 7 = 0 then ' https://publisher.example/' || doc_id || ' ' end as publisher_url,
    case when doc_id % 3 = 1 then 'https://example.org/' || doc_id || '.pdf' end as pdf_url,
    source, [case when doc_id % 2 = 0 then 'cs.LG' else 'q-bio.GN' end, lang] as keywords, cast(n_chars % 1000 as int) as citation_count
  from documents where doc_id is not null
)"""


def sectioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``paper_id, full_text``: every fourth line is preceded by a heading that the line number chooses."""
    d = spread(table(spark, sf_dir, "documents").where("doc_id is not null and text is not null"))
    heads = "array('Abstract', '1 Introduction', '2. Related Work', '3 Method', 'Results', 'References')"
    line = f"case when i % 4 = 0 then concat(element_at({heads}, cast(pmod(i div 4, 6) as int) + 1), '\\n', x) else x end"
    return d.select(F.col("doc_id"), F.col("doc_id").cast("string").alias("paper_id"), F.expr(f"array_join(transform(split(text, '\\n', -1), (x, i) -> {line}), '\\n')").alias("full_text"))


def cited_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``paper_id, full_text`` with numeric citations behind sentences and a bibliography of other titles."""
    d = spread(table(spark, sf_dir, "documents").where("doc_id is not null and text is not null"))
    mark = "regexp_replace(text, '([a-z]{3})[.] ', concat('$1 [', doc_id % 7 + 1, ', ', doc_id % 5 + 8, '-', doc_id % 5 + 10, ']. '))"
    entry = "concat('[', n, '] A. Author and B. Other. On the made result number ', doc_id % 50 * 20 + n, ' of corpora. Journal of Results, 20', lpad(cast(10 + n as string), 2, '0'), '. doi:10.1234/src', n, '.', n)"
    refs = f"array_join(transform(sequence(1, 15), n -> {entry}), '\\n')"
    return d.select(F.col("doc_id").cast("string").alias("paper_id"), F.expr(f"concat('Introduction\\n', {mark}, '\\nReferences\\n', {refs})").alias("full_text"))
