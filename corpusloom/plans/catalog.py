"""Registered queries over the driver's tables, one or more for each operator family, and their SQL."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions import quality as Q
from corpusloom.functions import text as T
from corpusloom.kernels.citing import Limits
from corpusloom.operators import asof, fulltext, identity, ranking, resolution, runs, sections, waves
from corpusloom.session import shared_folder, spread
from corpusloom.sources import payloads, perfile, sinks
from corpusloom.streaming import harvest

from .binding import CAND_SQL, candidates, cited_documents, sectioned, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _with(body: str, *more: str) -> str:
    return f"with {', '.join([CAND_SQL, *more])} {body}"


# SQL forms of the expressions
WS = r"'\s+'"
PLAIN = lambda x: f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"
DEHYPHEN = lambda x: rf"regexp_replace(regexp_replace({x}, '([a-z])-\s+([a-z])', '\1\2', 'g'), '([a-z])-\s+([a-z])', '\1\2', 'g')"
TITLE = lambda x: PLAIN(DEHYPHEN(f"coalesce({x}, '')"))
ARCHIVE = lambda x: rf"lower(trim(regexp_replace(regexp_replace(coalesce({x}, ''), '(?i)^(?:arxiv\s*:|https?://arxiv\.org/(?:abs|pdf)/)', ''), '(?i)v\d+$', '')))"
DOI = lambda x: rf"lower(regexp_replace(trim(regexp_replace(coalesce({x}, ''), '(?i)^(?:doi\s*:|https?://(?:dx\.)?doi\.org/)', '')), '[.,;:)\]}}''""]+$', ''))"
PMID = lambda x: rf"case when regexp_full_match(trim(regexp_replace(coalesce({x}, ''), '(?i)^pmid\s*:\s*', '')), '[0-9]+') then trim(regexp_replace({x}, '(?i)^pmid\s*:\s*', '')) else '' end"
BEST = lambda a, d, p, t: f"case when {ARCHIVE(a)} <> '' then 'arxiv:' || {ARCHIVE(a)} when {DOI(d)} <> '' then 'doi:' || {DOI(d)} when {PMID(p)} <> '' then 'pmid:' || ({PMID(p)}) when {TITLE(t)} <> '' then 'title:' || {TITLE(t)} else '' end"
STEM_VALUE = "coalesce(nullif(arxiv_id, ''), nullif(doi, ''), nullif(pmcid, ''), nullif(title, ''), 'paper')"
SLUG = f"trim(regexp_replace({STEM_VALUE}, '[^A-Za-z0-9._-]+', '_', 'g'), '._')"
STEM = f"left(case when {SLUG} = '' then 'paper' else {SLUG} end, 120)"
NUMBERS = lambda x: rf"len(regexp_extract_all(regexp_replace({x}, '([A-Za-z])[0-9]', '\1_', 'g'), '[-+]?[0-9]+(?:\.[0-9]+)?%?'))"
WORDS = lambda x: f"len(regexp_extract_all({x}, '[A-Za-z]+'))"
METRICS = lambda x: rf"len(regexp_extract_all({x}, '(?i)\b(?:AP|AP50|AP75|FLOPs?|top-?[15]|mAP|AUC|F1|params?)\b'))"
_NAMES = ", ".join("'" + " ".join("".join(c if c.isalnum() else " " for c in v.lower()).split()) + "'" for v in K.TOP_VENUES)
TIER = lambda venue, doi: f"case when len([v for v in [{_NAMES}] if contains(' ' || {PLAIN(venue)} || ' ', ' ' || v || ' ')]) > 0 then 3 when {PLAIN(venue)} not in ('', 'unknown', 'arxiv preprint') then 2 when coalesce({doi}, '') <> '' then 1 else 0 end"
UNESCAPE = lambda x: f"regexp_replace(replace(replace(replace(coalesce({x}, ''), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')"
ABSTRACT = lambda x: rf"trim(regexp_replace(trim(regexp_replace(regexp_replace({UNESCAPE(x)}, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '(?i)^abstract\s*[:.-]?\s*', ''))"


# Normalization


@query(_with(f"""select seq, {PLAIN('title')} as plain_title, {TITLE('title')} as title_key, {ARCHIVE('arxiv_id')} as archive_key, {DOI('doi')} as doi_key,
  {PMID('pmid')} as pmid_key, trim(regexp_replace(coalesce(abstract, ''), {WS}, ' ', 'g')) as clean_abstract, {STEM} as stem,
  substr(md5(coalesce(nullif(doi, ''), title)), 1, 12) as paper_hash from cand"""))  # fmt: skip
def normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return candidates(spark, sf_dir).select(
        "seq",
        T.plain_key(c("title")).alias("plain_title"),
        T.title_key(c("title")).alias("title_key"),
        T.archive_key(c("arxiv_id")).alias("archive_key"),
        T.doi_key(c("doi")).alias("doi_key"),
        T.pmid_key(c("pmid")).alias("pmid_key"),
        T.clean_space(c("abstract")).alias("clean_abstract"),
        T.output_stem(c("arxiv_id"), c("doi"), c("pmcid"), c("title")).alias("stem"),
        T.paper_hash(c("doi"), c("title")).alias("paper_hash"),
    )


@query(_with(f"""select seq, {BEST('arxiv_id', 'doi', 'pmid', 'title')} as best_identifier,
  case when {ARCHIVE('arxiv_id')} <> '' then 'ARXIV:' || {ARCHIVE('arxiv_id')} when {DOI('doi')} <> '' then 'DOI:' || {DOI('doi')} when {PMID('pmid')} <> '' then 'PMID:' || ({PMID('pmid')}) else '' end as batch_identifier,
  case when coalesce(arxiv_id, '') <> '' then 'arxiv:' || lower(arxiv_id) when coalesce(doi, '') <> '' then 'doi:' || lower(doi) when coalesce(pmid, '') <> '' then 'pmid:' || pmid else 'local:' || substr(sha1({TITLE('title')}), 1, 12) end as reference_identifier,
  case when pmcid is not null then 'PMC' || substr(pmcid, 4) end as pmcid,
  regexp_replace(case when contains(authors[1], ',') then lower(split_part(authors[1], ',', 1)) else '' end, '[^a-z0-9]+', '', 'g') as surname,
  array_to_string(list_filter_ids, '|') as lookup_ids
  from (select *, [x for x in [case when doi is not null and doi not like '10.48550/%' then doi end, trim(publisher_url), case when pmid is not null then substr(pmid, 7) end] if x is not null] as list_filter_ids from cand)"""))  # fmt: skip
def record_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return candidates(spark, sf_dir).select(
        "seq",
        T.best_identifier(c("arxiv_id"), c("doi"), c("pmid"), c("title")).alias("best_identifier"),
        T.batch_identifier(c("arxiv_id"), c("doi"), c("pmid")).alias("batch_identifier"),
        T.reference_identifier(c("title"), c("arxiv_id"), c("doi"), c("pmid")).alias("reference_identifier"),
        T.pmcid(c("pmcid")).alias("pmcid"),
        T.first_surname(c("authors")).alias("surname"),
        F.array_join(T.lookup_identifiers(c("doi"), c("publisher_url"), c("pmid")), "|").alias("lookup_ids"),
    )


@query(rf"""select page_id, {ABSTRACT('html')} as abstract, (length({ABSTRACT('html')}) >= 80 and not regexp_matches({ABSTRACT('html')}, '(?:…|\.\.\.)$')) as complete from pages""")
def clean_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = (F.length("abstract") >= 80) & ~F.col("abstract").rlike(r"(?:…|\.\.\.)\z")
    return table(spark, sf_dir, "pages").select("page_id", T.page_abstract(F.col("html")).alias("abstract")).withColumn("complete", complete)


@query(r"""select page_id, coalesce(nullif(regexp_extract(html, '(?is)<iframe[^>]+src\s*=\s*["'']([^"'']+\.pdf[^"'']*)["'']', 1), ''), nullif(regexp_extract(html, '(?is)<embed[^>]+src\s*=\s*["'']([^"'']+\.pdf[^"'']*)["'']', 1), ''), nullif(regexp_extract(html, '(?is)href\s*=\s*["'']([^"'']+\.pdf[^"'']*)["'']', 1), '')) as link,
  left(regexp_replace(trim(regexp_replace(regexp_replace(url, '[<>:"/\\|?*]', '_', 'g'), '\s+', ' ', 'g')), ' +$', ''), 150) as filename, substr(md5(url), 1, 12) as page_hash from pages""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", payloads.pdf_link(F.col("html")).alias("link"), T.safe_filename(F.col("url")).alias("filename"), T.short_hash(F.col("url")).alias("page_hash"))


# Quality


@query(rf"""select doc_id, {NUMBERS('text')} as numbers, {WORDS('text')} as words,
  (({NUMBERS('text')} >= 8 and {NUMBERS('text')} >= greatest(4, {WORDS('text')} // 3)) or {METRICS('text')} >= 5) as table_line,
  array_to_string([x for x in [case when length(text) > 40000 then 'method is implausibly long' end, case when contains(text, chr(0)) then 'method contains binary/OCR artifacts' end,
    case when regexp_matches(text, '(?i)\btable\s+[A-Z]?\d+\b') then 'method contains table/result content' end, case when regexp_matches(text, '(?i)\bfig(?:ure)?\.?\s*\d+\s*:') then 'method contains figure-caption content' end,
    case when regexp_matches(text, '(?i)copyright|all rights reserved|corresponding author') then 'method contains publication front matter' end,
    case when {NUMBERS('left(text, 1200)')} >= 20 and {NUMBERS('left(text, 1200)')} >= 0.25 * {WORDS('left(text, 1200)')} then 'method starts with a numeric result matrix' end] if x is not null], '; ') as method_errors,
  (contains(text, chr(0)) or regexp_matches(text, '(?i)\btable\s+[A-Z]?\d+\s*[:.]') or regexp_matches(text, '(?i)\bfig(?:ure)?\.?\s*\d+\s*:') or regexp_matches(text, '(?i)\[t\]\s*input\s*:\s*output\s*:') or regexp_matches(text, '(?i)copyright|all rights reserved') or regexp_matches(text, '(?:#\d+|\bc\|)') or ({NUMBERS('text')} >= 10 and {NUMBERS('text')} >= greatest(5, {WORDS('text')} // 3))) as noisy_summary
  from documents""")  # fmt: skip
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id",
        Q.count_of(t, K.NUMBER).cast("long").alias("numbers"),
        Q.count_of(t, K.LATIN_WORD).cast("long").alias("words"),
        Q.is_table_line(t).alias("table_line"),
        F.array_join(Q.method_errors(t), "; ").alias("method_errors"),
        Q.summary_is_noisy(t).alias("noisy_summary"),
    )


@query(_with(f"""select seq, (length(k) >= 15 and w between 3 and 40 and (year % 2 = 0 or (w >= 5 and length(k) >= 25))) as usable
  from (select seq, year, {TITLE('title')} as k, case when {TITLE('title')} = '' then 0 else len(string_split({TITLE('title')}, ' ')) end as w from cand)"""))
def usable_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("seq", Q.title_is_usable(F.col("title"), F.col("year") % 2 == 0).alias("usable"))


_FAILURES = "array(array('title is empty or too short', 'x'), array('pdf: unavailable'), array('arXiv source contains no TeX file'), array('timeout', 'gone'))"


@query("""select doc_id, case when doc_id % 4 in (0, 2) then 'quality_validation' else 'source_unavailable' end as category from documents""")
def failure_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = F.expr(f"element_at({_FAILURES}, cast(doc_id % 4 as int) + 1)")
    return table(spark, sf_dir, "documents").select("doc_id", Q.failure_category(errors).alias("category"))


# Ranks, shards, sets, statistics

_TIERED = f"tiered as (select *, {TIER('venue', 'doi')} as tier from cand)"
_RANKED = "ranked as (select *, row_number() over (order by tier desc, citation_count desc, year desc, seq) as rank from tiered)"


@query(_with("select seq, tier, citation_count as cites, rank, cast((rank - 1) % 3 as int) as shard from ranked", _TIERED, _RANKED))
def rank_and_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranking.rank_candidates(candidates(spark, sf_dir))
    return ranked.select("seq", "tier", "cites", "rank", ranking.shard_of(F.col("rank"), 3).alias("shard"))


@query(_with("""select seq, coalesce(nullif(case when old and coalesce(field, '') = '' then case when keywords[1] like 'cs.%' then 'Computer Science / ' else 'Quantitative Biology / ' end || substr(trim(venue), 8, length(trim(venue)) - 8) else field end, ''), 'Unknown') as field,
  coalesce(nullif(case when old then 'arXiv preprint' else venue end, ''), 'arXiv preprint') as venue from (select *, starts_with(trim(venue), 'arXiv (') as old from cand)"""))
def legacy_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.legacy_venue(candidates(spark, sf_dir)).select("seq", "field", "venue")


_DONE = "done as (select arxiv_id as processed_id from cand where venue = 'Nature' and arxiv_id is not null union select title from cand where venue = 'Unknown')"


@query(_with("select seq from cand where (arxiv_id is null or arxiv_id not in (select processed_id from done where processed_id is not null)) and (title is null or title not in (select processed_id from done where processed_id is not null))", _DONE))
def unprocessed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir)
    done = c.where("venue = 'Nature' and arxiv_id is not null").select(F.col("arxiv_id").alias("processed_id")).unionByName(c.where("venue = 'Unknown'").select(F.col("title").alias("processed_id")))
    return ranking.unprocessed(c, done).select("seq")


@query(_with(f"select distinct coalesce(nullif(arxiv_id, ''), nullif(title, '')) as processed_id from cand where {STEM} in (select {STEM} from cand where field = 'Unknown')"))
def processed_from_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir)
    stems = c.where("field = 'Unknown'").select(T.output_stem(F.col("arxiv_id"), F.col("doi"), F.col("pmcid"), F.col("title")).alias("stem"))
    return ranking.processed_by_output(c, stems)


@query(_with(f"select distinct {STEM} as stem from named where {STEM} not in (select {STEM} from cand)", "named as (select null::varchar as arxiv_id, doi, pmcid, title from cand)"))
def unmatched_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir)
    # Outputs named before archive ids were known: those of rows with such an id match nothing now.
    stems = c.select(T.output_stem(F.lit(None).cast("string"), F.col("doi"), F.col("pmcid"), F.col("title")).alias("stem"))
    return ranking.unmatched_outputs(stems, c)


@query(_with("""select count(*) as n_rows, count(*) filter (tier = 3) as n_top, count(*) filter (tier = 2) as n_formal, count(*) filter (tier < 2) as n_preprint, min(year) as min_year, max(year) as max_year,
  count(*) filter (coalesce(doi, '') <> '') as n_doi, count(*) filter ((coalesce(doi, '') <> '' and not regexp_matches(doi, '(?i)10\\.48550/arXiv[./]')) or coalesce(publisher_url, '') <> '' or coalesce(pmid, '') <> '') as n_eligible from tiered""", _TIERED))
def pool_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.pool_statistics(candidates(spark, sf_dir))


@query("select coalesce(nullif(source, ''), 'unknown') as source, count(*) as n from documents where doc_id is not null group by 1")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.source_counts(candidates(spark, sf_dir))


@query(_with("select seq, rank from ranked where rank <= coalesce((select case when count(*) = 40 then max(rank) end from (select rank from ranked where field like 'Field%' order by rank limit 40)), 9000000000)", _TIERED, _RANKED))
def success_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranking.rank_candidates(candidates(spark, sf_dir))
    return ranking.first_successes(ranked, F.coalesce(F.col("field"), F.lit("")).startswith("Field"), 40).select("seq", "rank")


@query(_with(f"""select seq, rank, ok from (select *, coalesce(sum(ok::int) over (order by rank rows between unbounded preceding and 1 preceding), 0) as before
  from (select seq, rank, length({TITLE('title')}) >= 15 and len(string_split({TITLE('title')}, ' ')) between 3 and 40 as ok from ranked)) where before < 60""", _TIERED, _RANKED))
def limited_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run tries that stops at its 60th usable title, in waves; the limit is the feature."""
    ranked = ranking.rank_candidates(candidates(spark, sf_dir)).select("seq", "title", "rank")
    attempt = lambda wave: wave.select("seq", "rank", Q.title_is_usable(F.col("title"), F.lit(True)).alias("ok"))
    tried = list(waves.ranked_waves(ranked, attempt, 60, least=16))
    return reduce(DataFrame.unionByName, tried, ranked.limit(0).select("seq", "rank", F.lit(True).alias("ok")))


@query(_with("select source, category, count(*) as n from (select case when seq % 3 <> 0 then 'arxiv' end as source, case when seq % 3 = 0 then case when seq % 2 = 0 then 'quality_validation' else 'source_unavailable' end end as category from cand) group by all"))
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir).selectExpr("case when seq % 3 <> 0 then 'arxiv' end as source", "array(case when seq % 2 = 0 then 'abstract is empty or too short' else 'gone' end) as errors")
    return ranking.outcome_counts(rows)


@query(_with("select seq, cast((row_number() over (order by year, seq) - 1) // 100 as int) as batch from cand"))
def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.batches(candidates(spark, sf_dir), 100, [F.asc("year"), F.asc("seq")]).select("seq", "batch")


@query(_with("select seq, part from (select *, row_number() over (order by part, seq) as n from (select seq, case when venue = 'Nature' then 0 else 1 end as part from cand)) where n <= 300"))
def budgeted_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir).select("seq", "venue")
    return ranking.budgeted_union([c.where("venue = 'Nature'").withColumn("part", F.lit(0)), c.where("venue <> 'Nature'").withColumn("part", F.lit(1))], 300).select("seq", "part")


def _listed(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _dated(values: tuple[str, ...], years: tuple[int, int], prefix: str, suffix: str, tag: str, g: int) -> str:
    return f"select {g} as g, i, y - {years[0]} as j, '{tag}' as tag, '' as cats, '{prefix}' || v || '{suffix} AND submittedDate:[' || y || '01010000 TO ' || y || '12312359]' as query from (select unnest({_listed(values)}) as v, unnest(range({len(values)})) as i), range({years[0]}, {years[1] + 1}) t(y)"


def _topical(values: tuple[str, ...], cats: tuple[str, ...], size: int, tag: str, g: int) -> str:
    n = -(-len(cats) // size)
    return f"select {g} as g, i, j, '{tag}' as tag, array_to_string(list_slice({_listed(cats)}, j * {size} + 1, j * {size} + {size}), ',') as cats, v as query from (select unnest({_listed(values)}) as v, unnest(range({len(values)})) as i), range({n}) t(j)"


_KNOWN_VENUES = "known as (select 'jr:\"' || venue || '\" AND submittedDate:[' || year || '01010000 TO ' || year || '12312359]' as query, count(*) as n from cand group by 1)"


@query(_with(
    "select pos, tag, cats, query, max, key, coalesce(n, 0) as n_known from (select row_number() over (order by g, i, j) - 1 as pos, tag, cats, query, cast(300 as int) as max, tag || ':' || cats || ':' || query as key from ("
    + " union all ".join((
        _dated(K.TOP_VENUES, K.VENUE_YEARS, 'jr:"', '"', "journal_venue", 0), _dated(K.TOP_VENUES, K.VENUE_YEARS, 'co:"', '"', "comment_venue", 1),
        _topical(K.COMPUTING_TOPICS, K.COMPUTING_CATEGORIES, 4, "cs_topic", 2), _topical(K.BIOLOGY_TOPICS, K.BIOLOGY_CATEGORIES, 3, "bio_topic", 3),
        _dated(K.SWEEP_TERMS, K.SWEEP_YEARS, "(", ")", "broad", 4),
    )) + ")) left join known using (query)", _KNOWN_VENUES
))
def search_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every search with the number of candidates held of its venue and year."""
    year = F.col("year").cast("string")
    query_of = F.concat(F.lit('jr:"'), "venue", F.lit('" AND submittedDate:['), year, F.lit("01010000 TO "), year, F.lit("12312359]"))
    known = candidates(spark, sf_dir).groupBy(query_of.alias("query")).agg(F.count("*").alias("n_known"))
    grid = ranking.search_tasks(spark).join(known, "query", "left").withColumn("n_known", F.coalesce("n_known", F.lit(0)))
    return grid.select("n_known", F.col("pos").cast("long").alias("pos"), "tag", F.coalesce(F.array_join("cats", ","), F.lit("")).alias("cats"), "query", "max", "key")


@query(_with(f"""select m.i * {len(K.CATEGORIES)} + c.j as pos, c.v as category, coalesce(k.n, 0) as n_known, 'submittedDate:[' || strftime(m.d, '%Y%m') || '010000 TO ' || strftime(last_day(m.d), '%Y%m%d') || '2359]' as date_range,
  regexp_replace(c.v, '^([^.]+)\\.(.*)$', '\\1:\\1:\\2') as oai_set
  from (select date '2026-07-01' - to_months(k::int) as d, k as i from range(139) t(k)) m, (select unnest({_listed(K.CATEGORIES)}) as v, unnest(range({len(K.CATEGORIES)})) as j) c
  left join (select keywords[1] as category, year, count(*) as n from cand group by all) k on c.v = k.category and year(m.d) = k.year"""))
def harvest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every harvest task with the number of candidates held of its category and year."""
    known = candidates(spark, sf_dir).groupBy(F.get("keywords", F.lit(0)).alias("category"), F.col("year").alias("_year")).agg(F.count("*").alias("n"))
    tasks = ranking.harvest_tasks(spark).withColumn("_year", F.substring("date_range", 16, 4).cast("int")).join(known, ["category", "_year"], "left")
    return tasks.select(F.coalesce("n", F.lit(0)).alias("n_known"), F.col("pos").cast("long").alias("pos"), "category", "date_range", ranking.set_name(F.col("category")).alias("oai_set"))


@query(_with("select seq, venue, field from cand where year between 2018 and 2022"))
def search_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.search_filter(candidates(spark, sf_dir), 2018, 2022).select("seq", "venue", "field")


# Resolution

_IDX = f"""idx as (select * from (select seq, trim(regexp_replace(coalesce(title, ''), {WS}, ' ', 'g')) as title, {ABSTRACT('abstract')} as abstract,
  nullif({ARCHIVE('arxiv_id')}, '') as a, nullif({DOI('doi')}, '') as d, nullif({PMID('pmid')}, '') as p from cand)
  where title <> '' and length(abstract) >= 80 and not regexp_matches(abstract, '(?:…|\\.\\.\\.)$'))"""
_TITLES = f"titles as (select k, max(seq) as s from (select seq, {TITLE('title')} as k, {BEST('a', 'd', 'p', 'title')} as b from idx) where k <> '' group by k having count(distinct b) = 1)"
_HIT = f"""hit as (select c.seq, coalesce(x.s, y.s, z.s, t.s) as hit_seq from (select seq, 'https://arxiv.org/abs/' || arxiv_id as arxiv_id, 'https://doi.org/' || doi || '.' as doi, pmid, ' ' || title || '!' as title from cand) c
  left join (select a, max(seq) as s from idx where a is not null group by a) x on {ARCHIVE('c.arxiv_id')} = x.a
  left join (select d, max(seq) as s from idx where d is not null group by d) y on {DOI('c.doi')} = y.d
  left join (select p, max(seq) as s from idx where p is not null group by p) z on {PMID('c.pmid')} = z.p
  left join titles t on {TITLE('c.title')} = t.k)"""


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.normalized_index(candidates(spark, sf_dir), plain=True)


def _probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates again, as another source writes their keys."""
    keys = {"arxiv_id": "concat('https://arxiv.org/abs/', arxiv_id)", "doi": "concat('https://doi.org/', doi, '.')", "title": "concat(' ', title, '!')", "id": "''", "citation_contexts": "cast(array() as array<string>)"}
    return candidates(spark, sf_dir).withColumns({k: F.expr(v) for k, v in keys.items()})


@query(_with("select * from hit", _IDX, _TITLES, _HIT))
def priority_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.match(_probe(spark, sf_dir), _index(spark, sf_dir)).select("seq", F.col("record.seq").alias("hit_seq"))


@query(_with(f"select h.seq, {BEST('i.a', 'i.d', 'i.p', 'i.title')} as id, i.title, i.abstract as summary from hit h join idx i on h.hit_seq = i.seq", _IDX, _TITLES, _HIT))
def resolved_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = resolution.finalize(resolution.match(_probe(spark, sf_dir), _index(spark, sf_dir)))
    return done.select("seq", F.col("resolved_id").alias("id"), F.col("resolved_title").alias("title"), "summary")


@query(_with("select seq from hit where hit_seq is null", _IDX, _TITLES, _HIT))
def pending_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.pending(_probe(spark, sf_dir), _index(spark, sf_dir), ["seq"]).select("seq")


@query(_with(f"select k as title_key from (select {TITLE('title')} as k, {BEST('a', 'd', 'p', 'title')} as b from idx) group by k having count(distinct b) > 1", _IDX))
def ambiguous_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.ambiguous_titles(_index(spark, sf_dir))


@query(_with(f"""select paper_id, seq, lookup_rank from (select (seq % 20)::varchar as paper_id, seq, row_number() over (partition by seq % 20 order by year desc, w desc, seq) as lookup_rank
  from (select *, {TITLE('title')} as k, len(string_split({TITLE('title')}, ' ')) as w from cand) where length(k) >= 15 and w between 3 and 40) where lookup_rank <= 12"""))
def title_lookup_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir).selectExpr("seq", "seq as ord", "cast(seq % 20 as string) as paper_id", "title", "year", "'x' as authors")
    return resolution.title_lookups(c, 12).select("paper_id", "seq", F.col("lookup_rank").cast("long").alias("lookup_rank"))


@query(_with(f"""select archive, seq, cast((row_number() over (order by seq, archive) - 1) // 100 as int) as batch from (select archive, min(seq) as seq from
  (select {ARCHIVE('arxiv_id')} as archive, seq from cand union all select {ARCHIVE("regexp_extract(doi, '(?i)^10[.]48550/arxiv[.](.+)$', 1)")}, seq from cand) where archive <> '' group by 1) where archive not in (select a from idx where a is not null)""", _IDX))
def lookup_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive ids that candidates name, as such or by an archive DOI, and that the whole index of complete records lacks."""
    c = candidates(spark, sf_dir)
    values = c.select("seq", T.archive_key(F.col("arxiv_id")).alias("archive")).unionByName(c.select("seq", T.archive_key(F.regexp_extract("doi", "(?i)^10[.]48550/arxiv[.](.+)$", 1)).alias("archive")))
    known = _index(spark, sf_dir).where("arxiv_id is not null").select(F.col("arxiv_id").alias("archive"))
    return resolution.lookup_batches(values, known, "archive", 100).select("archive", "seq", "batch")


_PUBS = "pubs as (select d, max_by(v, seq) as v, max_by(f, seq) as f from (select seq, " + DOI("doi") + " as d, case when seq % 8 = 0 then 'Journal ' || (seq % 40) end as v, case when seq % 12 = 0 then 'Subject ' || (seq % 5) else '' end as f from cand where doi is not null) where d <> '' group by d)"
#: The latest row of a DOI counts even where its venue is null, which max_by of a plain column would skip.
_PUBS = _PUBS.replace("max_by(v, seq) as v, max_by(f, seq) as f", "max_by({'v': v, 'f': f}, seq) as r")


@query(_with(f"""select c.seq, case when p.d is not null and trim(c.venue) in ('', 'arXiv preprint') then coalesce(nullif(p.r.v, ''), trim(c.venue)) else c.venue end as venue,
  case when p.d is not null and coalesce(c.field, '') in ('', 'Unknown') and coalesce(p.r.f, '') <> '' then p.r.f else c.field end as field from cand c left join pubs p on {DOI('c.doi')} = p.d""", _PUBS))
def enrich_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir)
    pubs = c.where("doi is not null").selectExpr("seq", "doi", "case when seq % 8 = 0 then concat('Journal ', seq % 40) end as venue", "case when seq % 12 = 0 then concat('Subject ', seq % 5) else '' end as field")
    return resolution.enrich(c, pubs).select("seq", "venue", "field")


@query()
def fuzzy_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir)
    damaged = F.regexp_replace("title", "^(.{12}).", "$1")
    # Only usable titles are ever looked up: that is the rule of the lookup, not a cut of the table.
    probe = c.where(Q.title_is_usable(F.col("title"), F.lit(True))).select(F.col("seq").alias("cand_id"), damaged.alias("title"), "year", F.get("authors", F.lit(0)).alias("authors"))
    return resolution.fuzzy_match(probe, c).select("cand_id", "record_seq")


# Order-dependent deduplication


@query()
def merged_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.merge_duplicates(candidates(spark, sf_dir)).select("seq", "arxiv_id", "doi", "venue", "field", "year")


@query()
def first_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.keep_first(candidates(spark, sf_dir)).select("seq")


def _harvested(spark: SparkSession, sf_dir: str, empty_is_key: bool) -> DataFrame:
    c = candidates(spark, sf_dir)
    return identity.merge_harvest(c.where("venue = 'Nature'"), c.where("venue <> 'Nature'"), empty_is_key=empty_is_key).select("seq")


@query()
def harvest_by_filled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _harvested(spark, sf_dir, False)


@query()
def harvest_by_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _harvested(spark, sf_dir, True)


# Harvests


@query(_with("select arxiv_id, title, year from (select arxiv_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) as title, year from cand where arxiv_id is not null) where title <> ''"))
def paged_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates with an archive id, written as harvest pages that name one another by tokens, and streamed back."""
    held = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    parts = ("<record><header><identifier>", F.col("seq").cast("string"), "</identifier></header><metadata><arXiv><id>", held(F.col("arxiv_id")), "</id><created>", F.col("year").cast("string"), "-01-01</created><title>", held(F.col("title")), "</title><categories>", held(F.get("keywords", F.lit(0))), "</categories></arXiv></metadata></record>")
    record = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    rows = ranking.batches(candidates(spark, sf_dir).where("arxiv_id is not null").select("seq", record.alias("record")), 100, [F.asc("seq"), F.asc("record")])
    bodies = rows.groupBy("batch").agg(F.array_join(F.sort_array(F.collect_list("record")), "").alias("body"))  # 100 records each
    last = F.lit(rows.agg(F.max("batch")).first()[0] or 0)
    token = lambda n: F.concat(F.lit("page-"), n.cast("string"))
    behind = F.when(F.col("batch") < last, F.concat(F.lit("<resumptionToken>"), token(F.col("batch") + 1), F.lit("</resumptionToken>"))).otherwise("")
    name = F.when(F.col("batch") == 0, "first.xml").otherwise(F.concat(F.sha1(token(F.col("batch"))), F.lit(".xml")))
    base = f"{shared_folder(spark).rstrip('/').removeprefix('file://').removeprefix('file:')}/harvest-{uuid.uuid4().hex}"
    spark.dataSource.register(perfile.FileSink)
    os.makedirs(f"{base}/pages/0")
    written = bodies.select(name.alias("file"), F.concat(F.lit("<OAI-PMH><ListRecords>"), "body", behind, F.lit("</ListRecords></OAI-PMH>")).alias("content"))
    written.write.format("per_file").option("path", f"{base}/pages/0").mode("append").save()
    stream = harvest.harvest_pages(spark, f"{base}/pages", ["0"]).select("arxiv_id", "title", "year")
    stream.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("arxiv_id string, title string, year int").parquet(f"{base}/rows")


# Sections and citations

_SECT = """ls as (select doc_id, string_split(text, chr(10)) as l from documents where doc_id is not null and text is not null),
lined as (select doc_id, unnest(l) as x, unnest(range(len(l))) as i from ls),
blocks as (select doc_id, ['abstract', 'introduction', 'related_work', 'method', 'experiments', 'references'][1 + (i // 4) % 6] as section, i // 4 as b, trim(string_agg(x, chr(10) order by i), ' ' || chr(10) || chr(9)) as body from lined group by all)"""


@query(f"with {_SECT} select doc_id, section, string_agg(body, chr(10) || chr(10) order by b) as body from blocks group by doc_id, section")
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sectioned(spark, sf_dir).select("doc_id", sections.split_sections(F.col("full_text")).alias("m"))
    return s.select("doc_id", F.explode("m").alias("section", "body"))


@query(f"with {_SECT} select doc_id, min_by(body, b) as abstract from blocks where section = 'abstract' group by doc_id")
def heading_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sectioned(spark, sf_dir).select("doc_id", sections.abstract_by_heading(F.col("full_text")).alias("abstract"))


@query("""with lined as (select doc_id, unnest(l) as x, unnest(range(len(l))) as i, l from (select doc_id, string_split(text, chr(10)) as l from documents where text is not null))
  select doc_id, cast(row_number() over (partition by doc_id order by i) - 1 as int) as hit, array_to_string(list_slice(l, greatest(i - 3, 0) + 1, i + 4), chr(10)) as snippet from lined where contains(lower(x), 'licens')""")
def keyword_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "documents").where("text is not null")
    return t.select("doc_id", F.posexplode(sections.keyword_windows(F.col("text"), "licens")).alias("hit", "snippet"))


@query("""select doc_id, case when contains(k, 'reference') or contains(k, 'bibliograph') then 'references' when regexp_matches(k, 'method|approach|model|framework|architecture|algorithm|experimental setup|implementation|training') then 'method'
  when contains(k, 'introduction') then 'introduction' when regexp_matches(k, 'result|evaluation') then 'experiments' when contains(k, 'discussion') then 'discussion' when contains(k, 'limitation') then 'limitations'
  when regexp_matches(k, 'conclusion|future work') then 'conclusion' when regexp_matches(k, 'related work|background') then 'related_work' end as section
  from (select doc_id, lower(['Human Preferences', 'Introduction to the Model', 'Results', 'Foo', 'Future Work', 'Background', '2 Introduction', 'Limitations'][1 + doc_id % 8]) as k from documents where doc_id is not null)""")
def canonical_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = "array('Human Preferences', 'Introduction to the Model', 'Results', 'Foo', 'Future Work', 'Background', '2 Introduction', 'Limitations')"
    d = table(spark, sf_dir, "documents").where("doc_id is not null")
    return d.select("doc_id", T.canonical_section(F.expr(f"element_at({heads}, cast(doc_id % 8 as int) + 1)")).alias("section"))


@query("""select doc_id, unnest(list_concat([cast(doc_id % 7 + 1 as int)], cast(range(doc_id % 5 + 8, doc_id % 5 + 11) as int[]))) as number from documents where doc_id is not null""")
def citation_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("doc_id is not null")
    return d.select("doc_id", F.explode(fulltext.marker_numbers(F.expr("concat(doc_id % 7 + 1, ', ', doc_id % 5 + 8, '-', doc_id % 5 + 10, ', 5-3; 1-40')"))).alias("number"))


@query("""select conv_id, turn, coalesce(lag(text) over w, '') as before, coalesce(lead(text) over w, '') as after from conversations window w as (partition by conv_id order by turn)""")
def neighbour_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fulltext.neighbours(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")
    return n.select("conv_id", "turn", F.array_join("context_before", "").alias("before"), F.array_join("context_after", "").alias("after"))


@query("""select event_id, ['unknown', 'introduction', 'method', 'conclusion'][1 + (case when o < 10 then 0 when o < 40 then 1 when o < 80 then 2 else 3 end)] as section from (select event_id, event_id % 100 as o from events)""")
def sections_at_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.expr("array(named_struct('off', 10, 'name', 'introduction'), named_struct('off', 40, 'name', 'method'), named_struct('off', 80, 'name', 'conclusion'))")
    return table(spark, sf_dir, "events").select("event_id", fulltext.section_at(starts, F.col("event_id") % 100).alias("section"))


_LINES = """lines as (select doc_id, ln, line, coalesce(nullif(regexp_extract(line, '[A-Za-z]+', 0), ''), 'none') as word from
  (select doc_id, unnest(range(len(ls))) as ln, unnest(ls) as line from (select doc_id, string_split(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), chr(10)) as ls from documents where doc_id is not null and text is not null)))"""


@query(f"""with {_LINES}, s as (select doc_id, ln, line || ' (' || upper(word) || ' et al., ' || (2000 + ln % 7) || ')' as text from lines),
  e as (select doc_id, ln as entry, word, 2000 + ln % 7 as year from lines where ln % 3 <> 0)
  select paper_id, entry, ord from (
    select s.doc_id::varchar as paper_id, cast(entry as int) as entry, cast(ln as int) as ord, row_number() over (partition by s.doc_id, entry order by ln) as i
    from s join e on s.doc_id = e.doc_id and regexp_matches(s.text, '(?is)\\b' || e.word || '\\b') and regexp_matches(s.text, '\\b' || e.year || '\\b')) where i <= 2""")
def author_year_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two lines that name the first word and the year of a line's entry; every third entry is cited by number."""
    d = spread(table(spark, sf_dir, "documents").where("doc_id is not null and text is not null"))
    ascii_ = F.regexp_replace("text", r"[^\x00-\x7F]", "")
    lines = d.select(F.col("doc_id").cast("string").alias("paper_id"), F.posexplode(F.split(ascii_, "\n", -1)).alias("ord", "line"))
    word = T.first_filled(F.regexp_extract("line", "[A-Za-z]+", 0), F.lit("none"))
    year = (2000 + F.col("ord") % 7).cast("string")
    sentences = lines.select("paper_id", "ord", F.concat("line", F.lit(" ("), F.upper(word), F.lit(" et al., "), year, F.lit(")")).alias("text"))
    entries = lines.select("paper_id", F.col("ord").alias("entry"), word.alias("surname"), year.alias("year"))
    return runs.author_year_links(sentences, entries, entries.where("entry % 3 = 0").select("paper_id", "entry"), most=2)


@query("""select e.event_id, p.v as last_error from events e asof left join
  (select user_id, ts, max(value) as v from events where event_type = 'error' and user_id is not null and ts is not null and value is not null group by all) p
  on e.user_id = p.user_id and e.ts >= p.ts""")
def events_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the value of its user's last error until then."""
    e = table(spark, sf_dir, "events")
    return asof.asof_join(e.select("event_id", "user_id", "ts"), e.where("event_type = 'error'"), "user_id", "ts", "value", "last_error").select("event_id", "last_error")


@query()
def sentence_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.col("text").alias("full_text"))
    return fulltext.sentence_records(d)


@query()
def cited_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fulltext.cited_works(cited_documents(spark, sf_dir), Limits()).select("paper_id", "ord", "id", "title", "year", "citation_context")


@query()
def bibliography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fulltext.bibliography_entries(cited_documents(spark, sf_dir))


@query()
def validated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: documents with citations, resolved against the index, through the output gate."""
    docs = cited_documents(spark, sf_dir).withColumns({"sections": F.lit(None).cast("map<string,string>"), "references": F.lit(None).cast("array<struct<number:int,key:string,raw:string,title:string,authors:string,year:string,venue:string,doi:string,arxiv_id:string,pmid:string,url:string>>")})
    c = candidates(spark, sf_dir)
    meta = c.select(F.col("seq").cast("string").alias("paper_id"), "title", "abstract", "field", "venue", "year")
    pool = c.select("seq", F.concat(F.lit("On the made result number "), F.col("seq"), F.lit(" of corpora")).alias("title"), "abstract", F.lit(None).cast("string").alias("arxiv_id"), "doi", F.lit(None).cast("string").alias("pmid"), "authors", "year")
    out = fulltext.build_outputs(docs, meta, resolution.normalized_index(pool, plain=True), min_references=2)
    return out.select("paper_id", "title", "field", "venue", "year", F.size("references").alias("n_references"), F.array_join("errors", "; ").alias("errors"))


@query(_with("select seq, title, year, field, venue, array_to_string(list_sort([k for k in case when seq % 3 = 0 then ['introduction', 'method'] else ['method'] end]), ',') as names from cand where seq % 5 <> 0"))
def corpus_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir).withColumn("sections", F.expr("case when seq % 5 <> 0 then case when seq % 3 = 0 then map('introduction', 'a', 'method', 'b', 'references', 'c') else map('method', 'b', 'references', 'c') end end"))
    kept = sinks.corpus_rows(c.withColumn("authors", F.array(F.col("seq").cast("string"))), ["introduction", "method"])
    return kept.select(F.get("authors", F.lit(0)).cast("long").alias("seq"), "title", "year", "field", "venue", F.array_join(F.array_sort(F.map_keys("sections")), ",").alias("names"))


@query(_with("select count(*) as total, count(*) filter (seq % 4 in (1, 2)) as downloaded, count(*) filter (seq % 4 = 2) as parsed, count(*) filter (seq % 4 = 3) as errors from cand"))
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.run_summary(candidates(spark, sf_dir).selectExpr("element_at(array('pending', 'downloaded', 'done', 'error'), cast(seq % 4 as int) + 1) as status"))
