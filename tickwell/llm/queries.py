"""Registered queries of this package, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm import (alignment, exact_dedup, importance, minhash, packing, pages, quality, quantised, repeats,
                          secrets, sentencepiece_lattice, token_counts, toxicity)
from tickwell.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run
    return register


@query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("text_key")


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), VOCABULARY, limit=1024)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "cut_chars")


@query()
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), VOCABULARY)
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.held_out())
    scored = docs.select("doc_id", toxicity.held_out().alias("held_out"), toxicity.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query()
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "group")


@query()
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated(table(spark, sf_dir, "documents")).drop("starts", "ends")


@query()
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"))


@query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_lattice.encode(table(spark, sf_dir, "documents"), PIECES)


@query(r"""
    WITH crc AS (
        SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS step),
    texts AS (
        SELECT doc_id, text, true AS own FROM documents UNION ALL SELECT NULL, text, false FROM benchmark),
    split AS (
        SELECT row_number() OVER () AS r, doc_id, own, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM texts),
    words AS (SELECT r, own, unnest(words) AS word FROM split),
    hexed AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM words),
    bucket_of AS (
        SELECT word, xor(4294967295, list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda k:
                   16 * (instr('0123456789ABCDEF', h[2 * k + 1]) - 1) + instr('0123456789ABCDEF', h[2 * k + 2]) - 1),
                   lambda c, b: xor(step[xor(c, b) % 256 + 1], c >> 8))) % 10000 AS bucket
        FROM hexed, crc),
    features AS (SELECT r, own, bucket FROM words JOIN bucket_of USING (word)),
    counts AS (
        SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM features GROUP BY bucket),
    gains AS (
        SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM counts)::DOUBLE + 10000)
                   / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM counts)::DOUBLE + 10000))))::BIGINT AS gain FROM counts),
    weights AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM features JOIN gains USING (bucket) WHERE own GROUP BY r),
    scored AS (
        SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((list_reduce(list_transform(range(8), lambda k:
                   (instr('0123456789abcdef', sha256('2024:' || doc_id)[k + 1]) - 1)::BIGINT), lambda x, y: 16 * x + y) + 0.5::DOUBLE)
                   / 4294967296)))::BIGINT AS score
        FROM split LEFT JOIN weights USING (r) WHERE own),
    placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
    FROM scored LEFT JOIN placed USING (doc_id)
""")
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), longest=1, buckets=10_000,
                               percent=10, least_words=20, seed="2024")


@query()
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), VOCABULARY, PIECES)


def _secrets_sql() -> str:
    """Every match by its place, and every window of every candidate counted anew."""
    window, quoted = secrets.WINDOW, lambda p: "'" + p.replace("'", "''") + "'"
    patterns = (secrets.ASSIGN, secrets.ACCESS, secrets.HEX, "[A-Za-z0-9+/_=-]{%d,}" % window)
    kinds = " UNION ALL ".join(
        f"SELECT r, {k} AS kind, regexp_split_to_array(t, {quoted(p)}) AS gaps, regexp_extract_all(t, {quoted(p)}) AS hits, "
        + (f"regexp_extract_all(t, {quoted(p)}, 2)" if k == 0 else "hits") + " AS words FROM d" for k, p in enumerate(patterns))
    limits = " ".join(f"WHEN regexp_full_match(word, {quoted(p)}) THEN {secrets.most(bits, window)}" for p, bits in secrets.CLASSES)
    allowed = " OR ".join(f"regexp_matches(word, {quoted(p)})" for p in secrets.ALLOWED)
    terms = ", ".join(str(secrets.term(c)) for c in range(1, window + 1))
    names = ", ".join(f"'{k}'" for k in secrets.KINDS)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    kinds AS ({kinds}),
    numbered AS (SELECT *, unnest(range(1, len(hits) + 1)) AS n FROM kinds WHERE len(hits) > 0),
    placed AS (
        SELECT r, kind, words[n] AS word, length(hits[n]) AS size,
               list_sum(list_transform(gaps[1:n], lambda x: length(x)))
               + coalesce(list_sum(list_transform(hits[1:n - 1], lambda x: length(x))), 0) AS start
        FROM numbered),
    candidates AS (SELECT DISTINCT word FROM placed WHERE kind = 3),
    starts AS (SELECT word, unnest(range(length(word) - {window - 1})) AS s FROM candidates),
    symbols AS (SELECT word, s, substr(word, s + 1 + i, 1) AS symbol FROM starts, range({window}) AS x(i)),
    counts AS (SELECT word, s, count(*) AS c FROM symbols GROUP BY word, s, symbol),
    windows AS (SELECT word, s, sum([{terms}][c]) AS total FROM counts GROUP BY word, s),
    judged AS (
        SELECT word, min(total) <= CASE {limits} ELSE -1 END AND NOT ({allowed}) AS fits FROM windows GROUP BY word),
    spans AS (
        SELECT r, kind, start, start + size AS stop FROM placed LEFT JOIN judged USING (word)
        WHERE CASE kind WHEN 0 THEN length(word) >= {secrets.ASSIGN_LENGTH} WHEN 3 THEN fits ELSE true END),
    written AS (
        SELECT r, kind, start, stop, [{names}][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS span FROM spans),
    by_row AS (
        SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
               string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans
        FROM written GROUP BY r)
    SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN by_row USING (r)
    """


@query(_secrets_sql())
def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))
