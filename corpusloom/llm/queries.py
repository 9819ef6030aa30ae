"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, jpeg, langid, lexical, linedup, mixing, pii, quality, repeats, shards, simhash, topk
from .common import read_table
from .sql import OP11_SQL, OP12_SQL, OP13_SQL

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_proportional_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(read_table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _held_out(modulus: int, remainder: int) -> Column:
    """False for a null id, which is never learnt from either."""
    same = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder
    return F.coalesce(same, F.lit(False)).alias("held_out")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", _held_out(4, 2), "score", "predicted")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", _held_out(5, 0), "lang_pred", "score")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(read_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), VOCABULARY, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.drop_repeated_lines(read_table(spark, sf_dir, "documents"))


def op10_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.digests(jpeg.store(read_table(spark, sf_dir, "documents")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations.damage(read_table(spark, sf_dir, "conversations"))
    return conversations.digests(turns, conversations.repair(turns))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"), outputs=("n_removed", "n_spans", "kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_proportional_shards,
        op2_quality,
        op3_exact_topk,
        op4_simhash,
        op5_language,
        op6_pii,
        op7_mixing,
        op8_bpe,
        op9_line_dedup,
        op10_jpeg,
        op11_conversation_repair,
        op12_lexical_search,
        op13_suffix_dedup,
    )
}

OP9_SQL = """
with lines as (
  select doc_id, unnest(range(len(ls))) as ln, unnest(ls) as line
  from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null)
),
counted as (
  select doc_id, ln, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as w from lines
),
summed as (
  select *, sum(w) over (partition by doc_id order by ln) as cw from counted
),
runs as (
  select a.doc_id, a.ln as a, min(b.ln) as z from summed a join summed b
    on a.doc_id = b.doc_id and b.ln >= a.ln and b.cw - a.cw + a.w >= 50 group by all
  union
  select b.doc_id, max(a.ln) as a, b.ln as z from summed a join summed b
    on a.doc_id = b.doc_id and b.ln >= a.ln and b.cw - a.cw + a.w >= 50 group by b.doc_id, b.ln
),
named as (
  select r.doc_id, r.a, r.z,
         md5(array_to_string(list_slice(string_split(d.text, chr(10)), r.a + 1, r.z + 1), chr(10))) as body, r.z - r.a as n
  from runs r join documents d using (doc_id)
),
later as (
  select doc_id, a, z from (
    select *, row_number() over (partition by body, n order by doc_id, a) as i from named
  ) where i > 1
),
gone as (
  select distinct s.doc_id, s.ln from summed s join later l on s.doc_id = l.doc_id and s.ln between l.a and l.z
),
kept as (
  select s.doc_id, string_agg(s.line, chr(10) order by s.ln) as text
  from summed s left join gone g on s.doc_id = g.doc_id and s.ln = g.ln where g.ln is null group by s.doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
       cast(coalesce(len(string_split(d.text, chr(10))), 0) as int) as n_lines,
       cast(coalesce(x.n, 0) as int) as n_deleted
from documents d left join kept k using (doc_id)
left join (select doc_id, count(*) as n from gone group by doc_id) x using (doc_id)
"""

OP1_SQL = """
with crc_table as (
  select list(c order by n) as t from (
    select n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(n)
  )
),
base as (
  select doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 as size,
         xor(list_reduce(list_concat([4294967295::bigint], [('0x' || b)::bigint for b in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
                         lambda c, x: xor(c >> 8, t.t[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32,
         coalesce(doc_id::varchar, '') || ':' || coalesce(md5(text), '') || ':' || coalesce('0' || source, '1') as k
  from documents, crc_table t
),
hashed as (
  select *, ('0x' || substr(md5('7:' || md5(k) || ':' || (row_number() over (partition by k) - 1)), 1, 15))::bigint as h from base
),
ranked as (
  select *, count(*) over (partition by source) as n,
         row_number() over (partition by source order by h, doc_id nulls first, text_crc32, size) as r
  from hashed
),
placed as (
  select *, row_number() over (order by (2 * r - 1)::double / (2 * n)::double, source nulls last, r) - 1 as pos, count(*) over () as total
  from ranked
),
cut as (select *, ((pos + 1) * 8 - 1) // total as shard from placed)
select doc_id, size, text_crc32, 'rows' as law, cast(shard as int) as shard,
       cast(pos - shard * total // 8 as bigint) as slot, cast(null as int) as grown_shard
from cut
"""

OP3_SQL = """
with v as (
  select vec_id, [floor(64 * x::double) for x in embedding] as e from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e)
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scored qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20
"""

OP7_SQL = """
with keyed as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
         coalesce(doc_id::varchar, '') || ':' || coalesce(md5(text), '') || ':' || coalesce('0' || source, '1') as k
  from documents
),
base as (
  select *, ('0x' || substr(md5('11:' || md5(k) || ':' || (row_number() over (partition by k) - 1)), 1, 15))::bigint as h from keyed
),
src as (select source, sum(size)::bigint as source_size from base group by source),
weighed as (
  select *, [3.0::double, 1.0::double, 2.0::double][1 + (row_number() over (order by source nulls last) - 1) % 3] as w,
         2.0::double * source_size as cap, 1.5::double * sum(source_size) over () as total from src
),
filled as (
  select *, (total - (sum(cap) over f - cap)) / (sum(w) over () - sum(w) over f + w) as level from weighed
  window f as (order by cap / w, source nulls last rows unbounded preceding)
),
chosen as (
  select first(level order by cap / w, source nulls last) as level from filled where cap >= level * w
),
targets as (
  select source, source_size, least(cap, c.level * w) as target from filled, chosen c
),
need as (
  select *, (target >= source_size)::int as whole,
         target - case when target >= source_size then source_size else 0 end as need from targets
),
cum as (
  select b.*, n.source_size, n.target, n.whole, n.need,
         sum(b.size) over (partition by b.source order by b.h range unbounded preceding)::double as cum
  from base b join need n on b.source is not distinct from n.source
),
steps as (
  select source, h, any_value(need) as need, any_value(cum) as cum, any_value(cum) - sum(size) as before from cum group by source, h
),
edge as (
  select source, case when cum - need < need - before then h else h - 1 end as lim from steps where before < need and cum >= need
)
select c.doc_id, c.size, c.source_size, c.target,
       cast(c.size * (c.whole + (c.h <= coalesce(e.lim, -1))::int) as bigint) as taken
from cum c left join edge e on c.source is not distinct from e.source
"""

ORACLE_SQL: dict[str, str] = {
    "op1_proportional_shards": OP1_SQL,
    "op3_exact_topk": OP3_SQL,
    "op7_mixing": OP7_SQL,
    "op9_line_dedup": OP9_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_suffix_dedup": OP13_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
