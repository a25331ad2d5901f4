"""The registered queries of the corpus operators, and the SQL of those that have any."""

from __future__ import annotations

import base64
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmarts.config import scratch_path

from . import decontaminate, lexical_search, license_scan, lm_scoring, minhash, pii, quantization, sentencepiece_bpe, sharding, suffix_dedup, token_counts, toxicity, turn_repair
from .common import table

SHARDS = 24
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, threshold=0.8)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentencepiece_bpe.digest(docs, PIECE_MODEL, keep=["doc_id"])


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.train(docs), keep=["doc_id"])


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert all documents under two tokenizer versions, delete those of quality 0, revise
    those whose repeated lines go, apply the deletes again (no effect), and read the totals."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    with open(BYTE_BPE, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    byte_pairs = token_counts.BytePairCounter("byte_bpe_50k", ranks, public_tokenizers.PATTERN)

    def counted(rows: DataFrame) -> DataFrame:
        words = token_counts.count_tokens(rows, "words", token_counts.count_words)
        return words.unionByName(token_counts.count_tokens(rows, "byte_bpe_50k", byte_pairs))

    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "token-rollup"))
    low = table(spark, sf_dir, "labels").where("quality = 0")
    rollup.apply("0001-load", inserts=counted(docs))
    rollup.apply("0002-low-quality", deletes=low)
    rollup.apply("0003-repeated-lines", revisions=counted(token_counts.without_repeated_lines(docs)))
    rollup.apply("0002-low-quality", deletes=low)
    return rollup.totals()


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.find_contamination(docs, bench, ["doc_id"]))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.hilbert_shards(table(spark, sf_dir, "documents"), SHARDS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantization.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.report(toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id"]))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id counts as the empty text, whose remainder is 0: it is learned from."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1).alias("held_out"))
    return lm_scoring.score(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of ``.!?``, repeated or made the user's, by the remainder
    of their key; a null is one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("way"),
    ).where("way != 0")
    copies = F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = turn_repair.repair(damaged(conversations)).withColumnRenamed("conv_id", "c")
    every = conversations.select("conv_id").distinct()
    zero, empty = F.lit(0).cast("long"), F.lit("")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *[F.coalesce(n, zero).alias(n) for n in numbers], F.coalesce("audit", empty).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(empty.cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_personal_data": op3_personal_data,
    "op4_token_counts": op4_token_counts,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_hilbert_shards": op7_hilbert_shards,
    "op8_embeddings": op8_embeddings,
    "op9_license_scan": op9_license_scan,
    "op10_toxicity": op10_toxicity,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_lexical_search": op12_lexical_search,
    "op13_turn_repair": op13_turn_repair,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_K = license_scan.K
_TEMPLATES = ", ".join(
    f"({i}, '{phrase}', '{label}', {i < len(license_scan.PHRASES)})" for i, (phrase, label) in enumerate((*license_scan.PHRASES, *license_scan.NOTICES))
)

ORACLES: dict[str, str] = {
    "op6_decontaminate": f"""
with d as (select row_number() over () as r, doc_id, {_TERMS.format("coalesce(text, '')")} as w from documents),
i as (select row_number() over () as r, item_id, {_TERMS.format("coalesce(text, '')")} as w from benchmark),
sized as (select *, least(len(w), 10) as k from i where len(w) > 0),
windows as (
    select distinct item_id, k, array_to_string(w[b : b + k - 1], ' ') as g
    from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as b from sized)
),
lengths as (select distinct k from windows),
places as (
    select r, k, b, array_to_string(w[b : b + k - 1], ' ') as g
    from (select r, w, k, unnest(range(1, len(w) - k + 2)) as b from d cross join lengths where len(w) >= k)
),
found as (select p.r, p.k, p.b, x.item_id from places p join windows x on p.k = x.k and p.g = x.g),
hit as (
    select r, count(distinct pos) as n_hit
    from (select r, unnest(range(b, b + k)) as pos from (select distinct r, k, b from found)) group by r
),
items as (select r, list_sort(list(distinct cast(item_id as varchar))) as ids from found where item_id is not null group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
    cast(coalesce(len(t.ids), 0) as bigint) as n_items, sha256(coalesce(array_to_string(t.ids, ','), '')) as items_sha256,
    coalesce(h.n_hit, 0) > 0 as contaminated
from d left join hit h on d.r = h.r left join items t on d.r = t.r
""",
    "op9_license_scan": f"""
with t as (select template, label, base, string_split(phrase, ' ') as w from (values {_TEMPLATES}) v(template, phrase, label, base)),
template_grams as (
    select template, label, base, len(w) - {_K - 1} as t_grams, j as t_pos, array_to_string(w[j + 1 : j + {_K}], ' ') as g
    from (select *, unnest(range(0, len(w) - {_K - 1})) as j from t)
),
d as (select row_number() over () as r, doc_id, {_TERMS.format("coalesce(text, '')")} as w from documents),
places as (
    select r, p, array_to_string(w[p + 1 : p + {_K}], ' ') as g
    from (select r, w, unnest(range(0, len(w) - {_K - 1})) as p from d)
),
votes as (
    select r, template, label, base, t_grams, p - t_pos as diagonal, list(distinct t_pos) as hits
    from places join template_grams using (g) group by r, template, label, base, t_grams, p - t_pos
),
opened as (
    select *, coalesce(diagonal - lag(diagonal) over (partition by r, template order by diagonal) > {license_scan.MERGE}, false) as opens
    from votes where not base
),
merged as (
    select r, template, label, t_grams, unnest(hits) as t_pos,
        sum(cast(opens as int)) over (partition by r, template order by diagonal rows unbounded preceding) as span
    from opened
),
notices as (
    select r, label, count(distinct t_pos) / t_grams as share from merged group by r, template, label, t_grams, span
),
found as (
    select r, label, base, diagonal, cast(1 as double) as share from votes where base and len(hits) = t_grams
    union all select r, label, false, null, share from notices where share >= cast({license_scan.LEAST_SHARE} as double)
),
by_doc as (
    select r, count(*) filter (base) as n_base, min(diagonal) as first_word, max(diagonal) as last_word,
        list_sort(list(distinct label) filter (base)) as base_labels, list_sort(list(distinct label)) as labels, max(share) as score
    from found group by r
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base,
    cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
    coalesce(array_to_string(base_labels, ','), '') as base_labels, coalesce(array_to_string(labels, ','), '') as labels,
    coalesce(score, cast(0 as double)) as score
from d left join by_doc on d.r = by_doc.r
""",
    "op12_lexical_search": f"""
with d as (select row_number() over () as r, doc_id, {_TERMS.format("coalesce(text, '')")} as w from documents),
sizes as (select cast(count(*) as bigint) as n_docs, cast(sum(len(w)) as bigint) as n_terms from d where len(w) > 0),
tf as (select r, term, cast(count(*) as bigint) as tf from (select r, unnest(w) as term from d) group by r, term),
df as (select term, count(*) as df from tf group by term),
i as (
    select row_number() over () as q, item_id, {_TERMS.format("coalesce(text, '')")} as w
    from (select distinct item_id, text from benchmark)
),
qtf as (select q, item_id, term, count(*) as n from (select q, item_id, unnest(w) as term from i) group by all),
weight as (
    select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
    from df cross join sizes
),
scored as (
    select qtf.q, qtf.item_id, d.r, d.doc_id, cast(sum(
        qtf.n * weight.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * len(d.w) * n_docs) // n_terms)))
    ) as bigint) as score
    from qtf join weight on qtf.term = weight.term join tf on qtf.term = tf.term join d on tf.r = d.r cross join sizes
    group by qtf.q, qtf.item_id, d.r, d.doc_id
),
ranked as (
    select *, row_number() over (partition by q order by score desc, doc_id nulls last) as rank from scored where score > 0
)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 20
""",
}
