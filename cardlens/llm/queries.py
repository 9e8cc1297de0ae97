"""Registered queries of this folder: one ``opN_<name>`` per operator, each over
its whole table with production parameters.  ``SQL`` holds the DuckDB form where
SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.session import scratch_path

from . import balanced, byte_bpe, warc
from .best_fit import pack_best_fit
from .common import read
from .decontaminate import contamination
from .fingerprints import fingerprints
from .hard_negatives import hard_negatives
from .jaccard_join import jaccard_components
from .licenses import license_scan
from .shards import base_tree, shard_rows
from .spelling import count_words, spelling_variants
from .token_counts import token_counts
from .toxicity import held_out, toxicity

WORD_IDS = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 1
CAPACITY = 2048

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of each document: five-word shingles, similarity 0.8."""
    return jaccard_components(read(spark, sf_dir, "documents")).drop("set_id", "group")


SQL["op8_jaccard_join"] = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select doc_id, case when len(w) >= 5 then list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from w),
e as (select doc_id, len(s) as n, unnest(s) as x from s),
pairs as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as c from e a join e b on a.x = b.x and a.doc_id <> b.doc_id
  group by all),
links as (select a, b from pairs where 100 * c >= 80 * (na + nb - c)),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a, min(b) as component_id from reach group by a)
select s.doc_id, cast(len(s) as bigint) as n_shingles, component_id from s join least on least.a = s.doc_id"""


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed best-fit-decreasing: one row per sequence with its id matrix row."""
    return pack_best_fit(read(spark, sf_dir, "documents"), WORD_IDS, END_ID, CAPACITY)


@query
def op3_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of near equal cost: one row per piece."""
    return balanced.pieces(balanced.pack_balanced(read(spark, sf_dir, "documents"), WORD_IDS, END_ID, CAPACITY))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each whole text, and whether they are more than 512."""
    return token_counts(read(spark, sf_dir, "documents"), BYTE_BPE, 512)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap with benchmark items, with the best overlap of each pair."""
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each whole text, learned from document labels, with the worst sentence."""
    scored, x = toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", held_out(scored["doc_id"]).alias("held_out"), scored[x["toxic_score"]].alias("score"),
        (scored[x["toxic_score"]] >= 0.5).cast("int").alias("predicted"), scored[x["n_offending"]].alias("n_offending"),
        scored[x["worst_start"]].alias("worst_start"), scored[x["worst_end"]].alias("worst_end"),
        scored[x["worst_score"]].alias("worst_score"))


@query
def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 24 shards by a weighted hash tree, and to 25 by the grown tree."""
    rows = shard_rows(read(spark, sf_dir, "documents"), base_tree(24))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of each whole text and of its edited text."""
    return fingerprints(read(spark, sf_dir, "documents"))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back from byte ranges."""
    path = scratch_path(spark, "warc")
    warc.write_warc(read(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, with_payload=False).select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of("refers_to").alias("refers_to"))


SQL["op1_warc"] = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as d from pages),
 g as (select d, max(page_id) as last from p where n >= 1000 group by d having count(*) > 1)
select p.page_id, cast(p.n as bigint) as payload_bytes, p.d as payload_digest,
  case when g.last <> p.page_id then 'revisit' else 'response' end as record_type,
  case when g.last <> p.page_id then g.last end as refers_to
from p left join g on p.d = g.d and p.n >= 1000"""


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in each whole text."""
    return license_scan(read(spark, sf_dir, "documents"))


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each whole text and the bytes they decode to, as digests."""
    encoded = byte_bpe.encode(read(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    rows, decoded = byte_bpe.decode(encoded, BYTE_RANKS)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(decoded, 256).alias("decoded_sha256"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all texts, one in 199 of them misspelled by rule."""
    return spelling_variants(count_words(read(spark, sf_dir, "documents"), delete_every=199))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each anchor's best positives, with one label in seven of the ids moved on."""
    rows = read(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    return hard_negatives(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)))


SQL["op11_hard_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x
  from embeddings where label is not null and embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label,
    cast(list_inner_product(a.x, b.x) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
  cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank,
  s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on p.anchor_id = s.anchor_id and s.label <> s.anchor_label
  and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) <= 5"""


#: accented letters and, for each, an ASCII character that no word has: the edit distance of SQL counts bytes
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_STAND_INS = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c not in "'\\")[:len(_ACCENTED)]

SQL["op13_spelling_variants"] = f"""
with recursive crc as (select list(c order by b) as t from (select b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, cast(3988292384 as bigint)) else c >> 1 end) as c from range(256) as r(b))),
runs as (select doc_id, w, count(*) as n from (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as w from documents) group by doc_id, w having length(w) >= 6),
keyed as (select w, n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || w)) as x from runs),
hashed as (select w, n, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(length(x) // 2),
    lambda i: cast('0x' || substr(x, cast(2 * i + 1 as integer), 2) as bigint))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h from keyed, crc),
altered as (select case when h % 199 = 0 then substr(w, 1, cast(h % length(w) as integer)) || substr(w, cast(h % length(w) as integer) + 2) else w end as word, n from hashed),
words as (select word, cast(sum(n) as bigint) as n, translate(word, '{_ACCENTED}', '{_STAND_INS}') as m from altered
  group by word having length(word) >= 6 and sum(n) >= 5),
near as (select a.word, b.word as other, b.n from words a join words b on a.m[1] = b.m[1] and abs(length(a.m) - length(b.m)) <= 1 and levenshtein(a.m, b.m) = 1
  union select a.word, b.word, b.n from words a join words b on a.m[-1] = b.m[-1] and abs(length(a.m) - length(b.m)) <= 1 and levenshtein(a.m, b.m) = 1),
best as (select word, count(*) as n_near, first(other order by n desc, encode(other)) as other, max(n) as most from near group by word),
forms as (select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.most >= 5 * w.n then b.other end as form, case when b.most >= 5 * w.n then b.most end as form_n
  from words w left join best b on w.word = b.word),
ways as (select word, word as root, form as next from forms union all select w.word, f.word, f.form from ways w join forms f on w.next = f.word)
select f.word, f.form, w.root, f.n, cast(f.n_near as bigint) as n_near, cast(f.form_n as bigint) as form_n from forms f join ways w on f.word = w.word and w.next is null"""
