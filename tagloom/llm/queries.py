"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tagloom.llm import alignment, decontaminate, html_text, lines, minhash, negatives, pieces, preferences, quality, repeats, sequences, sharding, token_counts
from tagloom.llm.ship import ship

WORD_BPE, PIECE_BPE, BYTE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"
TOKEN_LIMIT = 2048
SHARDS = [f"shard-{i:04d}" for i in range(1000)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.without_repeats(table(spark, sf_dir, "documents"), length=200)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "_quality.*").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_divergence", "word_divergence"
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_text.extracted(table(spark, sf_dir, "pages"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_BPE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pieces.decoded(pieces.encoded(docs, path), path)
    return rows.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        pieces.count(F.col("ids")).alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        pieces.round_trip(F.col("text"), F.col("decoded")).alias("round_trip"),
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    rows = preferences.answers(turns)
    flat = lambda m: F.array_join(F.transform(m, lambda s: F.concat_ws("+", s["start"].cast("string"), s["length"].cast("string"))), ",")
    return rows.withColumns({"chosen_mask": flat(F.col("chosen_mask")), "rejected_mask": flat(F.col("rejected_mask"))})


def op7_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = sequences.write_sequences(docs, public_tokenizers.path(WORD_BPE), sequences.sequence_folder(spark), end_id=1)
    return sequences.read_sequences(manifest)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.placed(table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes")), F.col("doc_id"), SHARDS)
    return rows.select("doc_id", "n_bytes", "slot", "shard")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.without_repeated_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_token_counts,
        op3_quality_rules,
        op4_html_extraction,
        op5_sentencepiece,
        op6_chat_formatting,
        op7_arrow_sequences,
        op8_minhash,
        op9_sharding,
        op10_decontamination,
        op11_alignment,
        op12_hard_negatives,
        op13_line_dedup,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op8_minhash": r"""
        with recursive texts as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') as words
            from documents
        ), shingles as (
            select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 4 then [array_to_string(words, ' ')]
                else list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) end) as shingle
            from texts
        ), sizes as (
            select doc_id, count(*) as n from shingles group by doc_id
        ), links as (
            select a.doc_id as x, b.doc_id as y
            from shingles a join shingles b using (shingle) join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id
            where a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id, m.n, n.n having 100 * count(*) >= 80 * (m.n + n.n - count(*))
        ), reached as (
            select doc_id, doc_id as other from documents
            union select r.doc_id, l.y from reached r join links l on l.x = r.other
        ), components as (
            select doc_id, min(other) as component_id from reached group by doc_id
        )
        select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
        from components left join sizes using (doc_id)""",
    "op10_decontamination": r"""
        with texts as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
            from documents
        ), items as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
            from benchmark
        ), windows as (
            select distinct item_id, least(len(words), 10) as n,
                   unnest(list_transform(range(1, len(words) - least(len(words), 10) + 2),
                                         lambda i: array_to_string(words[i:i + least(len(words), 10) - 1], ' '))) as phrase
            from items where len(words) > 0
        ), places as (
            select doc_id, n, unnest(range(1, len(words) - n + 2)) as pos, words from texts, (select distinct n from windows) where len(words) >= n
        ), found as (
            select doc_id, n, pos, item_id from places join windows using (n) where array_to_string(words[pos:pos + n - 1], ' ') = phrase
        ), covered as (
            select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(pos, pos + n)) as word from found) group by doc_id
        ), held as (
            select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
            from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
        )
        select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from texts left join covered using (doc_id) left join held using (doc_id)""",
    "op12_hard_negatives": """
        with vectors as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as units
            from embeddings
            where label is not null and embedding is not null and vec_id is not null
              and coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)
        ), scored as (
            select a.vec_id as anchor_id, a.label = o.label as same, o.vec_id as other_id,
                   cast(list_sum(list_transform(list_zip(a.units, o.units), lambda p: p[1] * p[2])) as bigint) as score
            from vectors a join vectors o on a.vec_id <> o.vec_id where a.vec_id % 50 = 0
        ), positives as (
            select anchor_id, other_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
        )
        select anchor_id, positive_id,
               cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as integer) as rank,
               other_id as negative_id, positive_score, score as negative_score
        from positives join scored using (anchor_id)
        where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        qualify row_number() over (partition by anchor_id, positive_id order by score desc, other_id) <= 3""",
    "op13_line_dedup": """
        with split as (
            select doc_id, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as lines from documents
        ), numbered as (
            select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from split
        ), keyed as (
            select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from numbered
        ), repeated as (
            select key, max(doc_id) as keeper from keyed where length(key) >= 20
            group by key having count(distinct doc_id) >= 3
        ), judged as (
            select doc_id, pos, line, coalesce(doc_id <> keeper, false) as gone from keyed left join repeated using (key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
        from judged group by doc_id""",
}
