"""Registered queries of this package over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shelfscope.llm import alignment, archives, decontaminate, jaccard_join, langid, line_dedup, pieces, prefix_trie, quality, rules, secrets, shards, toxicity
from shelfscope.llm.common import remainder, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 3) == 1
    scored = toxicity.tag(docs, toxicity.train(docs, labels, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "toxic_spans")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it again."""
    docs = table(spark, sf_dir, "documents")
    return pieces.round_trip(docs).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "same_text")


def op3_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), "url", "html")
    return archives.through_archives(pages).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, with the benchmark items it covers to the threshold."""
    docs = table(spark, sf_dir, "documents")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("contaminated", F.lit(False)).alias("contaminated"), F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        "best_item", F.coalesce("best_coverage", F.lit(0.0)).alias("best_coverage"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = rules.train(docs, table(spark, sf_dir, "labels"))
    return rules.judged(docs, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    found = langid.identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op10_quality_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 5) == 0
    scored = quality.predict(docs, quality.train(docs, labels, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conv_ids = prefix_trie.with_borrowed_heads(prefix_trie.turn_index(table(spark, sf_dir, "conversations")))
    nodes, ends = prefix_trie.prefix_trie(turns, conv_ids)
    digests = prefix_trie.joined_ids_sha256(ends)
    return nodes.join(digests, ["x", "y"], "left").fillna(prefix_trie.NO_IDS, ["ends_sha256"]).drop("x", "y")


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shards.shuffled_shards(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", shards.text_size().alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "bucket",
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (op1_toxicity, op2_pieces, op3_archives, op4_jaccard_join, op5_decontamination, op6_quality_rules, op7_line_dedup,
              op8_language_mixture, op9_secrets, op10_quality_embeddings, op11_alignment, op12_prefix_trie, op13_shards, pipeline)
}

_EDGE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL: dict[str, str] = {
    "op3_archives": """
with hashed as (
  select page_id, octet_length(encode(coalesce(html, ''))) payload_bytes, sha1(coalesce(html, '')) hex from pages),
bits as (
  select page_id, payload_bytes, hex,
         list_aggregate(list_transform(range(1, 41), lambda i:
           substr('0000000100100011010001010110011110001001101010111100110111101111',
                  4 * (strpos('0123456789abcdef', substr(hex, cast(i as integer), 1)) - 1) + 1, 4)), 'string_agg', '') b
  from hashed),
coded as (
  select page_id, payload_bytes, hex,
         list_aggregate(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  cast(16 * cast(substr(b, cast(5 * i + 1 as integer), 1) as integer) + 8 * cast(substr(b, cast(5 * i + 2 as integer), 1) as integer)
                  + 4 * cast(substr(b, cast(5 * i + 3 as integer), 1) as integer) + 2 * cast(substr(b, cast(5 * i + 4 as integer), 1) as integer)
                  + cast(substr(b, cast(5 * i + 5 as integer), 1) as integer) + 1 as integer), 1)), 'string_agg', '') payload_digest
  from bits),
firsts as (select hex, min(page_id) first_id from hashed group by hex)
select page_id, cast(payload_bytes as bigint) payload_bytes, payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end record_type,
       case when page_id = first_id then null else first_id end refers_to
from coded join firsts using (hex)""",
    "op7_line_dedup": f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) pos
  from documents),
keyed as (select doc_id, pos, line, translate(trim(line, {_EDGE}), '{_UPPER}', '{_LOWER}') k from lines),
common as (
  select k, max(doc_id) holder from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
marked as (
  select doc_id, pos, line, holder is not null and holder <> doc_id gone from keyed left join common using (k))
select doc_id, count(*) n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) kept_sha256
from marked group by doc_id""",
    "op12_prefix_trie": """
with bytes as (
  select list(list_reduce(list_prepend(i, range(8)), lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end) order by i) t
  from (select unnest(range(256)) i)),
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, sha) pos, sha, n_words
  from (select conv_id, turn, sha256(sha256(coalesce(role, '')) || coalesce(text, '')) sha,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) n_words
        from conversations where conv_id is not null)),
convs as (
  select conv_id, conv_id - conv_id % 20 lender, n_own,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(conv_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
           lambda x, c: xor(x // 256, t[cast(xor(x, c) % 256 + 1 as integer)])), 4294967295) % 4 h
  from (select conv_id, count(*) n_own from turns group by conv_id), bytes),
plan as (
  select c.conv_id, c.lender, c.h, least(c.h, coalesce(l.n_own, 0)) k from convs c left join convs l on l.conv_id = c.lender),
rebuilt as (
  select p.conv_id, t.pos, t.sha, t.n_words from plan p join turns t on t.conv_id = p.lender and t.pos <= p.h
  union all
  select p.conv_id, t.pos - p.h + p.k, t.sha, t.n_words from plan p join turns t on t.conv_id = p.conv_id and t.pos > p.h),
paths as (
  select conv_id, 0 as depth, '' as node, 0 as n_words from convs
  union all
  select conv_id, pos, string_agg(sha, '') over (partition by conv_id order by pos), n_words from rebuilt),
lengths as (select conv_id, max(depth) depth from paths group by conv_id),
nodes as (
  select node, depth, min(conv_id) conv_id, count(*) n_convs, (count(*) - 1) * max(n_words) saved from paths group by node, depth),
children as (select left(node, len(node) - 64) node, count(*) n from nodes where depth > 0 group by all),
ends as (
  select p.node, string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id) ids
  from paths p join lengths l using (conv_id, depth) group by p.node),
leaves as (
  select n.*, coalesce(c.n, 0) n_children, case when c.n is null then 1 else 0 end leaf from nodes n left join children c using (node)),
sums as (
  select v.node, sum(w.leaf) n_leaves, sum(w.saved) saved_tokens
  from leaves w, unnest(range(0, w.depth + 1)) u(d), nodes v where v.node = left(w.node, 64 * u.d) group by v.node)
select l.conv_id, cast(l.depth as bigint) depth, p.conv_id parent_conv_id, l.n_convs, l.n_children, cast(s.n_leaves as bigint) n_leaves,
       cast(s.saved_tokens as bigint) saved_tokens, sha256(coalesce(e.ids, '')) ends_sha256
from leaves l join sums s using (node) left join ends e using (node)
left join nodes p on l.depth > 0 and p.node = left(l.node, len(l.node) - 64)""",
}
