"""The operators as named queries over the shared tables, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import content_sort, hard_negatives, html, language, lexical, nearest, packing, piece_scan, pivots, sharding, simhash, token_counts, toxicity
from tallyloom.llm.common import held_out, table, trainable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.withColumn("fingerprint", simhash.fingerprint_hex("fingerprint"))


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the law ``rows``: counts at most one apart."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shuffle_into_shards(docs, 40)
    return placed.withColumns(sharding.text_digests()).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length histogram of all documents with suffix sums."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.suffix_sums(token_counts.length_histogram(docs))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 tokens; the ids as their CRC-32."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "goes_back", "goes_on"
    )


@query
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.search(rows, F.col("vec_id") % 100 == 0)


@query
def op8_pivot_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and survivor of every vector."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.where(trainable()), labels.where(trainable()))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.score(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(trainable()))
    return language.identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


@query
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html.extract(pages)
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document as count and CRC-32, and whether they decode to the text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = piece_scan.encode(docs, decoded="decoded")
    # Marks in a text are read as spaces, which is what the vocabulary can say.
    same = F.coalesce(F.replace("text", F.lit(piece_scan.MARK), F.lit(" ")), F.lit("")) == F.col("decoded")
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        same.alias("round_trip"),
    )


@query
def op11_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents: the row that stays, the size of the group, a digest of the normalised text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = content_sort.deduplicate(docs)
    digest = F.sha2(content_sort.normalised("text"), 256).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", digest)


ORACLES["op11_content_sort"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS normalised FROM documents
), same AS (
    SELECT normalised, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY normalised
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normalised) AS text_sha256
FROM texts JOIN same USING (normalised)
"""


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = lexical.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"))


ORACLES["op12_ranked_search"] = r"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), held AS (
    SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term
), sizes AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id
), totals AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals
    WHERE term IN (SELECT term FROM asked) GROUP BY term, docs
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the vectors whose id is divisible by 100, after relabelling every seventh."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = """
WITH used AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS whole
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.whole, b.whole)::BIGINT AS score
    FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), near AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM scored WHERE same
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM near WHERE place <= 5
), negatives AS (
    SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS place
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 10
"""
