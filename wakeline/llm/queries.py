"""Registered queries of this subpackage, each over its whole table, and the oracle SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import decontaminate, langid, mixing, phrases, pieces, quality, runs, secret_scan, simhash, spans, syncmers, urls, warc
from wakeline.llm.common import WORD, table, whole_text


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.report(table(spark, sf_dir, "documents"), ends=True)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


OP5_SQL = """
WITH p AS (
 SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
 CASE WHEN p.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN p.page_id > f.first_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""


def op6_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in documents whose id has a crc32 divisible by ten, the end of the text repeats some of its words."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(f"regexp_extract_all(coalesce(text, ''), r'{WORD}', 0)")
    rows = docs.select("doc_id", "text", F.floor(hashed / 10).alias("g"), F.when(hashed % 10 == 0, words).alias("w"))
    n = F.size("w")
    start = F.col("g") % n
    period = 1 + F.floor((n - start) / (3 + F.col("g") % 8))
    place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period)
    repeated = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", place(i).cast("int"))), " ")
    return rows.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.select("*", runs.strongest(F.col("runs")).alias("best"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(table(spark, sf_dir, "documents"), path, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH t AS (
 SELECT coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM t),
g AS (
 SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (VALUES (1), (2), (3)) s(k) WHERE i + k - 1 <= len(w)
), f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (
 SELECT c.lang, c.k, c.phrase, c.w, c.a, x.f AS l, y.f AS r, c.cut,
  CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
 FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
 JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
 SELECT lang, phrase, max(a) AS a FROM (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3
 ) GROUP BY ALL
), kept AS (
 SELECT b.* FROM best b LEFT JOIN around o ON b.lang = o.lang AND b.phrase = o.phrase WHERE o.a IS NULL OR 100 * o.a < 50 * b.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank, k.phrase, k.a, k.l, k.r, n.n, k.score
FROM kept k JOIN n ON n.lang = k.lang
QUALIFY row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) <= 2000
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_substring_dedup, op3_mix_sources, op4_url_filters, op5_warc,
        op6_syncmer_fingerprints, op7_secret_scan, op8_language_id, op9_decontamination, op10_simhash_near_dup, op11_periodic_runs, op12_piece_tokens, op13_collocations,
    )
}
ORACLES = {"op5_warc": OP5_SQL, "op13_collocations": OP13_SQL}
