"""The registered queries of this package, each over its whole table, and the SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    decontamination,
    host_suffixes,
    importance_resampling,
    license_scan,
    order_minhash,
    pu_quality,
    reply_trees,
    semi_markov_pii,
    speculative_bpe,
    tensored_minhash,
    token_alignment,
    token_prefixes,
    warc,
)
from tidelog.llm.common import landed, table

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def vocabulary_file(name: str) -> bytes:
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, and whether they exceed a context of 1024."""
    counts = token_prefixes.count_tokens(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op10_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every text, as digests."""
    return speculative_bpe.digests(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, learnt from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = pu_quality.train(docs, labels)
    scores = pu_quality.scored(docs.select("doc_id", "text"), weights)
    return scores.select(
        "doc_id", pu_quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose two-word shingle sets are similar by 0.8 or more."""
    return tensored_minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, similarity=80)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item where a passage of the document holds the item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), decontamination.indexes(table(spark, sf_dir, "benchmark")))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back by byte ranges."""
    records = warc.read(warc.write(table(spark, sf_dir, "pages")), payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: base matches, and the spans that the field adds."""
    docs = table(spark, sf_dir, "documents")
    return semi_markov_pii.spans(docs, semi_markov_pii.train(docs))


@query
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return host_suffixes.main_text(table(spark, sf_dir, "pages"))


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of every text and of its edited text."""
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


@query
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that is hard to escape, formatted and read back."""
    hard = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hard).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = landed(reply_trees.conversations(reply_trees.threads(rows)), "formatted")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return reply_trees.read_back(formatted).select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of 20 words and more, drawn towards the word distribution of the benchmark."""
    return importance_resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10)


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every text."""
    scanned = license_scan.scan(table(spark, sf_dir, "documents"))
    phrases = F.filter("matches", lambda m: m["phrase"])
    places = F.transform(phrases, lambda m: m["first_word"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(phrases).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        license_scan.labels_of(phrases).alias("base_labels"),
        license_scan.labels_of(F.col("matches")).alias("labels"),
        "score",
    )


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of a byte-level and a piece vocabulary, weighed by their counts in the corpus."""
    return token_alignment.statistics(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model"))


_WORDS_SQL = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op11_resampling"] = f"""
WITH doc_words AS (SELECT doc_id, {_WORDS_SQL.format("coalesce(text, '')")} AS words FROM documents),
bench_words AS (SELECT unnest({_WORDS_SQL.format("coalesce(text, '')")}) AS word FROM benchmark),
crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS crc
    FROM range(256) AS r(i)
),
distinct_words AS (SELECT DISTINCT word FROM (SELECT unnest(words) AS word FROM doc_words UNION ALL SELECT word FROM bench_words)),
letters AS (
    SELECT word, list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT) AS bytes FROM distinct_words
),
bucket_of AS (
    SELECT word, xor(list_reduce([4294967295] || bytes, lambda c, b: xor(crc[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 10000 AS bucket FROM letters, crc_table
),
features AS (SELECT doc_id, bucket FROM (SELECT doc_id, unnest(words) AS word FROM doc_words) JOIN bucket_of USING (word)),
s AS (SELECT bucket, count(*) AS n FROM features GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bench_words JOIN bucket_of USING (word) GROUP BY bucket),
gains AS (
    SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
        / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t ON s.bucket = t.bucket
),
weights AS (SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM features JOIN gains USING (bucket) GROUP BY doc_id),
scores AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM doc_words LEFT JOIN weights USING (doc_id)
),
drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20
)
SELECT scores.doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank FROM scores LEFT JOIN drawn USING (doc_id)
"""

ORACLE["op1_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
hashed AS (SELECT *, sha1(html) AS digest FROM payloads),
spelled AS (
    SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(digest, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)), '') AS payload_digest
    FROM hashed
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to, NULL::VARCHAR AS error
FROM spelled
"""

ORACLE["op3_chat"] = r"""
WITH hard AS (SELECT '\### Assistant: </turn> ok' AS text),
rows AS (
    SELECT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', text FROM hard UNION ALL SELECT -7, 1, 'assistant', text FROM hard
),
turns AS (
    SELECT *, length(role) + len(regexp_extract_all(role, '[\\>]')) + length(text) + len(regexp_extract_all(text, '<\\*/?turn')) + length('<turn role=></turn>') + 1 AS width FROM rows
),
joined AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learnt, sum(width)::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt)::BIGINT AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM joined
"""

ORACLE["op6_near_duplicates"] = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) < 2 THEN words ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingles FROM texts
),
sized AS (SELECT doc_id, shingles, len(shingles)::BIGINT AS n FROM sets),
parts AS (SELECT doc_id, n, unnest(shingles) AS shingle FROM sized),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, x.n AS n, y.n AS m, count(*) AS common FROM parts x JOIN parts y
    ON x.shingle = y.shingle AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY ALL
),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (n + m - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS other FROM sized UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other),
grouped AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT s.doc_id, n AS n_shingles, component_id, s.doc_id = component_id AS kept FROM sized s JOIN grouped USING (doc_id)
"""
