"""Registered queries of the corpus operators, each with its SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.llm import (
    exact_dedup,
    language_id,
    lexical_search,
    mixing,
    multi_index,
    multiset_hash,
    packing,
    page_text,
    simhash,
    slots,
    suffix_dedup,
    toxicity,
    whitening,
)
from flowsieve.llm.common import held_out, read_table, stored, word_count
from flowsieve.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the vocabulary files are: FLOWSIEVE_TOKENIZERS, or the installed public_tokenizers."""
    folder = os.environ.get("FLOWSIEVE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


@query()
def op1_inverted_multi_index(spark, sf_dir):
    """The 20 nearest found of every twentieth vector."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return multi_index.nearest_neighbours(vectors, F.col("id") % 20 == 0)


@query(
    r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '-' || CAST(size AS VARCHAR))) AS ord
  FROM documents
),
sources AS (
  SELECT *, CAST([3, 1, 2][(place - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap
  FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n,
      row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
  )
),
levels AS (
  SELECT *, cap / weight AS brim,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (
      ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (
      ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
),
targets AS (
  SELECT source, place, n, source_size, least(cap, coalesce(weight * (
    SELECT level FROM levels WHERE level <= brim ORDER BY brim, place LIMIT 1), cap)) AS target
  FROM levels
),
quotients AS (
  SELECT place, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place, k) AS r,
    round((SELECT sum(target) FROM targets) / 32) AS seats
  FROM targets, unnest(range(0, CAST(target / 32 AS BIGINT) + 50)) AS u(k) WHERE target > 0
),
quotas AS (SELECT place, count(*) AS blocks FROM quotients WHERE r <= seats GROUP BY place),
placed AS (
  SELECT s.*, t.place, t.source_size, t.target,
    CAST('0x' || substr(ord, 1, 8) AS BIGINT) % CAST(ceil(sqrt(t.n) / 8) AS BIGINT) AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
shards AS (
  SELECT place, shard, CAST(sum(size) AS BIGINT) AS words FROM placed
  GROUP BY place, shard HAVING sum(size) > 0
),
shard_quotients AS (
  SELECT place, shard, blocks,
    row_number() OVER (PARTITION BY place ORDER BY words::DOUBLE / (2 * k + 1) DESC, shard, k) AS r
  FROM shards JOIN quotas USING (place), unnest(range(0, blocks + 1)) AS u(k)
),
shard_quotas AS (
  SELECT place, shard, least(count(*) * 32, words * 2) AS quota, words
  FROM shard_quotients JOIN shards USING (place, shard) WHERE r <= blocks
  GROUP BY place, shard, words
),
runs AS (
  SELECT place, shard, words, quota // words AS passes, quota % words AS rest,
    CAST('0x' || substr(md5('mix-1|' || place || '|' || shard), 1, 8) AS BIGINT)
      % CAST(ceil(words / 32) AS BIGINT) * 32 AS start
  FROM shard_quotas
),
lined AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY place, shard ORDER BY ord, doc_id NULLS LAST, size
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
  FROM placed
)
SELECT doc_id, size, source_size, target, CAST(coalesce(passes * size
  + greatest(0, least(stop, words, start + rest) - greatest(stop - size, start))
  + greatest(0, least(stop, start + rest - words) - (stop - size)), 0) AS BIGINT) AS taken
FROM lined LEFT JOIN runs USING (place, shard)
"""
)
def op2_sainte_lague_mix(spark, sf_dir):
    """Words of every document that the mix takes."""
    docs = read_table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(stored(sized, "sizes"), size="size")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_virtual_slots(spark, sf_dir):
    """Every document's shard and place by the newest version of the slot map."""
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id", slots.text_size(F.col("text")).alias("size"), F.crc32(text).alias("text_crc32"),
        # Rows without a doc_id get a number, which is stored with them.
        F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("_nth"),
    )
    sharded = slots.shard_documents(
        stored(narrow, "sizes"), 16, scratch_path(spark, "slot-map"), size="size",
        keys=["doc_id", "text_crc32", "_nth"],
    )
    return sharded.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot"
    )


@query()
def op4_best_fit_decreasing(spark, sf_dir):
    """Every piece of every document with its sequence and its place there."""
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, vocabulary_path())


@query()
def op5_simhash_pivots(spark, sf_dir):
    """Every document's fingerprint and near-duplicate component."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query(
    r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
    AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""
)
def op8_heavy_hitter_dedup(spark, sf_dir):
    """Every document with its group of equal texts and whether it stays."""
    docs = read_table(spark, sf_dir, "documents")
    digests = docs.select("doc_id", exact_dedup.text_digest(F.col("text")).alias("text_sha256"))
    marked = exact_dedup.mark_duplicates(stored(digests, "digests"), digest="text_sha256")
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op9_kneser_ney_language(spark, sf_dir):
    """Predicted language of every document, learnt from four fifths of them."""
    docs = read_table(spark, sf_dir, "documents")
    models = language_id.fit(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = language_id.identify(docs.select("doc_id", "text"), models)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query()
def op10_segment_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from the labels of four fifths of them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(
        docs.filter(~held_out(F.col("doc_id"))), labels.filter(~held_out(F.col("doc_id")))
    )
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
        F.size("passages").alias("n_passages"),
    )


@query()
def op6_hash_suffix_dedup(spark, sf_dir):
    """What is left of every document without the byte strings of 200 that occur elsewhere."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs, with_kept=False)
    return found.select(
        "doc_id", "n_bytes", "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256",
    )


@query()
def op7_recurrent_page_text(spark, sf_dir):
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return page_text.extract(pages, page_text.fit(pages)).select("page_id", "url", "text", "n_chars")


@query()
def op11_cholesky_jacobi_whitening(spark, sf_dir):
    """Every vector on each of the 32 components of largest variance, whitened."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query()
def op12_multiset_fingerprints(spark, sf_dir):
    """Every document's fingerprint, that of its edited text, and how like they are."""
    return multiset_hash.fingerprints(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::HUGEINT AS n FROM postings GROUP BY doc_id),
corpus AS (SELECT count(*)::HUGEINT AS documents, sum(n)::HUGEINT AS total FROM lengths),
shares AS (SELECT doc_id, 100 - 75 + ((75 * n * documents) // total) AS m FROM lengths, corpus),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
queries AS (SELECT item_id, term, count(*) AS repeats FROM asked GROUP BY item_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * documents + 2) / (2 * count(*) + 1)))::HUGEINT AS w
  FROM postings, corpus WHERE term IN (SELECT term FROM queries) GROUP BY term, documents
),
scores AS (
  SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM queries JOIN weights USING (term) JOIN postings USING (term) JOIN shares USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
  doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
)
def op13_max_sketch_search(spark, sf_dir):
    """The ten highest-scoring documents of every benchmark item."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.ranked(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
