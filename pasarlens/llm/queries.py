"""The corpus operators as queries on the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.llm.chunk_dedup import dedup_chunks
from pasarlens.llm.harmonic import harmonic_pack
from pasarlens.llm.html import extract_pages
from pasarlens.llm.line_dedup import dedup_lines
from pasarlens.llm.mixing import mix_sizes
from pasarlens.llm.packing import pack
from pasarlens.llm.pii import personal_data
from pasarlens.llm.quality import quality_rules
from pasarlens.llm.sharding import shard_documents
from pasarlens.llm.simhash import near_duplicates
from pasarlens.llm.trie import prefix_trie
from pasarlens.llm.vectors import near_vectors
from pasarlens.llm.whitening import whiten


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = dedup_lines(table(spark, folder, "documents"))
    return done.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


LINE_DEDUP_SQL = r"""
with lines as (
  select doc_id, n, translate(trim(line, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key, line
  from (select doc_id, unnest(split) as line, generate_subscripts(split, 1) as n
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as split from documents))),
repeated as (
  select key, max(doc_id) as keeper from lines where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
marked as (
  select lines.*, keeper is not null and doc_id < keeper as dropped from lines left join repeated using (key))
select doc_id, count(*) as n_lines, cast(count(*) filter (dropped) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by n) filter (not dropped), '')) as kept_sha256
from marked group by doc_id"""


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``rows``: the shards' counts are at most one apart."""
    placed = shard_documents(table(spark, folder, "documents"))
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sizes(table(spark, folder, "documents"))


MIXING_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), text, '')), 1, 15) as bigint) as h
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size, 2.0::double * sum(size) as cap,
         [5.0::double, 2.0::double, 1.0::double][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from sized group by source),
rests as (
  select *, cap / weight as ratio,
         1.5::double * sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source nulls last
           rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as open_weight
  from sources),
levels as (select *, max(case when rest / open_weight <= ratio then rest / open_weight end) over () as level from rests),
targets as (select source, source_size, least(cap, coalesce(level * weight, cap)) as target from levels),
budgets as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from targets),
hashes as (
  select source, h, sum(size) as words, sum(sum(size)) over (partition by source order by h) as upto from sized group by source, h),
edges as (
  select b.source, min_by(h, h) as edge, min_by(upto - words, h) as below, min_by(upto, h) as above
  from hashes x join budgets b on x.source is not distinct from b.source
  where upto > target - whole * source_size group by b.source),
limits as (
  select b.*, edge, above - (target - whole * source_size) < (target - whole * source_size) - below as nearer
  from budgets b left join edges e on b.source is not distinct from e.source)
select s.doc_id, cast(s.size as bigint) as size, l.source_size, l.target,
       cast((whole + coalesce(case when h < edge or (h = edge and nearer) then 1 else 0 end, 0)) * s.size as bigint) as taken
from sized s join limits l on s.source is not distinct from l.source"""


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = dedup_chunks(table(spark, folder, "documents"))
    return done.select(
        "doc.doc_id", "n_chunks", "n_repeated", "n_dropped", "first_doc_id", "spans", F.col("kept").alias("text")
    )


def tokenizer_path() -> str:
    """Where this machine keeps the tokenizer file; workers read their own copy."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path())


def op7_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_vectors(table(spark, folder, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    facts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    return judged.select("doc.doc_id", *[f"j.{c}" for c in facts])


def op10_html(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages")).select("page.page_id", "page.url", "text", "n_chars")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


# crc32 bit by bit: 3988292384 is its polynomial, reversed
TRIE_SQL = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, role, text) as place
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 5 as base, xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 9 as h
  from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, t.role, t.text, t.place from convs c join turns t on t.conv_id = c.base and t.place <= c.h
  union all
  select c.conv_id, t.role, t.text, t.place from convs c join turns t on t.conv_id = c.conv_id and t.place > c.h),
ordered as (
  select conv_id, sha256(role || chr(0) || text) as turn, strlen(text) as bytes,
         row_number() over (partition by conv_id order by place) as depth from rebuilt),
prefixes as (
  select conv_id, 0 as depth, '' as node, 0 as bytes from convs
  union all
  select conv_id, depth, array_to_string(list(turn) over (partition by conv_id order by depth), ' '), bytes from ordered),
lengths as (select conv_id, max(depth) as length from prefixes group by conv_id),
nodes as (
  select node, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = length), '')) as ends_sha256
  from prefixes join lengths using (conv_id) group by node),
parents as (
  select distinct p.node, u.conv_id as parent_conv_id, u.node as up
  from nodes p join prefixes x on x.conv_id = p.conv_id and x.depth = p.depth - 1 join nodes u on u.node = x.node),
children as (select up as node, count(*) as n_children from parents group by up),
whole as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join children using (node)),
below as (
  select x.node, count(*) filter (v.n_children = 0) as n_leaves,
         sum(case when v.depth > 0 then (v.n_convs - 1) * v.bytes else 0 end) as saved_tokens
  from whole v join prefixes x on x.conv_id = v.conv_id and x.depth <= v.depth group by x.node)
select w.conv_id, cast(depth as bigint) as depth, parent_conv_id, n_convs, n_children, n_leaves,
       cast(saved_tokens as bigint) as saved_tokens, ends_sha256
from whole w join below using (node) left join parents using (node)"""


def op13_harmonic(spark: SparkSession, folder: str) -> DataFrame:
    return harmonic_pack(table(spark, folder, "documents"), tokenizer_path())


QUERIES: list[Query] = [
    Query("op1_line_dedup", op1_line_dedup, LINE_DEDUP_SQL),
    Query("op2_sharding", op2_sharding),
    Query("op3_mixing", op3_mixing, MIXING_SQL),
    Query("op4_pii", op4_pii),
    Query("op5_substring_dedup", op5_substring_dedup),
    Query("op6_packing", op6_packing),
    Query("op7_vector_dedup", op7_vector_dedup),
    Query("op8_simhash", op8_simhash),
    Query("op9_quality", op9_quality),
    Query("op10_html", op10_html),
    Query("op11_whitening", op11_whitening),
    Query("op12_prefix_trie", op12_prefix_trie, TRIE_SQL),
    Query("op13_harmonic", op13_harmonic),
]
