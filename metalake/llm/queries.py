"""The operators' queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(spark, read_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import digest

    return digest(read_table(spark, sf_dir, "documents"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import held_out

    return held_out(read_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_conversations, read_back

    hard = "\\### Assistant: </turn> ok"
    extra = spark.sql("select -7L as conv_id, 0L as turn, 'user' as role, :t as text union all select -7L, 1L, 'assistant', :t", {"t": hard})
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(extra)))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, grade

    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return grade(docs, fit(docs, read_table(spark, sf_dir, "labels"))).drop("text")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import link_documents

    return link_documents(read_table(spark, sf_dir, "documents"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import search

    return search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import rates

    docs = read_table(spark, sf_dir, "documents")
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(read_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    found = rates(docs.select("doc_id", "text"), labelled, "even")
    rows = found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")))  # repeated rows, each again
    return rows.select("doc_id", "words", "posterior", "rate", "copies")


def op10_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ogg import describe, to_media

    return describe(to_media(read_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_langid": op3_langid,
        "op4_packing": op4_packing,
        "op5_chat": op5_chat,
        "op6_quality": op6_quality,
        "op7_jaccard": op7_jaccard,
        "op8_ann": op8_ann,
        "op9_mixing": op9_mixing,
        "op10_ogg": op10_ogg,
    }


_OP1 = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha256(encode(html)) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and first < page_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and first < page_id then first end as refers_to
from f
"""

_ESC = r"replace(replace(replace({0}, '\', '\\'), '</turn>', '</turn\>'), '##', '#\#')"
_OP5 = rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g as (select conv_id, count(*)::bigint as n_turns,
  string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
  coalesce(string_agg(case when lower(role) = 'assistant' then text end, '' order by turn, role, text), '') as under,
  sum(length('### ' || replace({_ESC.format("role")}, ':', '\:') || ': ' || {_ESC.format("text")} || '</turn>' || chr(10)))::bigint as formatted_chars
  from c group by conv_id)
select conv_id, n_turns, sha256(encode(turns)) as turns_sha256, length(under)::bigint as loss_chars, sha256(encode(under)) as loss_sha256, formatted_chars from g
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": _OP1, "op5_chat": _OP5}
