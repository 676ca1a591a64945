"""Registered queries of the text operators: thin calls over whole tables, and their SQL."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrarank.llm.alignment import align
from terrarank.llm.common import WORD_REGEX, table
from terrarank.llm.decontaminate import contaminated_pairs
from terrarank.llm.fingerprints import fingerprint_neighbours
from terrarank.llm.licences import scan_licences
from terrarank.llm.line_runs import MIN_RUN, PASSAGE_WORDS, remove_repeated_lines
from terrarank.llm.mixing import MOST_COPIES, ROUNDS, mixture
from terrarank.llm.pii import find_pii
from terrarank.llm.quality import classify
from terrarank.llm.simhash import simhash_components
from terrarank.llm.substrings import WINDOW, remove_repeated_windows
from terrarank.llm.tokens import read_token_digests, write_tokens
from terrarank.llm.warc import ID_PREFIX, ID_SUFFIX, normalise, read_warc, write_warc
from terrarank.llm.whitening import whiten
from terrarank.session import checkpoint_dir

END_ID = 2


def token_digests(docs: DataFrame) -> DataFrame:
    """Write ``docs`` as token shards into the shared folder and read every document's ids back."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), END_ID, special_as_text=False)
    return read_token_digests(spark, path)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives of one gzip stream each, normalise them, and read every record back by its index."""
    folder = f"{checkpoint_dir(pages.sparkSession)}/llm-warc-{uuid.uuid4().hex}"
    indexed = normalise(write_warc(pages, f"{folder}/whole", min_bytes=min_bytes), f"{folder}/members")

    def number(record_id: str) -> Column:
        return F.nullif(F.regexp_replace(record_id, f"^{ID_PREFIX}|{ID_SUFFIX}$", ""), F.lit("")).cast("long")

    return read_warc(indexed, payloads=False).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                                                     "record_type", number("refers_to").alias("refers_to"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeated_lines(table(spark, sf_dir, "documents"), passage_words=PASSAGE_WORDS)
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), width=3, radius=3)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def op11_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"), min_bytes=0)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                  public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_token_output": op3_token_output,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_source_mixture": op8_source_mixture,
    "op9_personal_data": op9_personal_data,
    "op10_licence_scan": op10_licence_scan,
    "op11_warc_archives": op11_warc_archives,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_alignment": op13_token_alignment,
}

def _mixture_sql() -> str:
    """Caps by the order of size over weight; certain sizes from the largest down; each round's order sample by a running sum over the whole order."""
    rounds, chosen = [], "false"
    for k in range(ROUNDS):
        limit = "true" if k == 0 else f"size <= floor(budget{k})"
        rounds.append(f"""
        b{k} AS (SELECT *, greatest(rest - coalesce(sum(size) FILTER (WHERE {chosen}) OVER (PARTITION BY source), 0), 0) AS budget{k}
            FROM {f"r{k - 1}" if k else "keyed"}),
        o{k} AS (SELECT *, NOT ({chosen}) AND key IS NOT NULL AND {limit} AS open{k} FROM b{k}),
        r{k} AS (SELECT *, open{k} AND sum(size) FILTER (WHERE open{k}) OVER (
            PARTITION BY source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= budget{k} AS taken{k} FROM o{k})""")
        chosen = " OR ".join(f"coalesce(taken{j}, false)" for j in range(k + 1))
    return rf"""
        WITH docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD_REGEX}')) AS size,
                   (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || coalesce(text, '')), 1, 13) AS BIGINT)
                    + CAST(0.5 AS DOUBLE)) / 4503599627370496 AS u
            FROM documents),
        sized AS (SELECT source, sum(size) AS source_size FROM docs GROUP BY source),
        weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized),
        sorted AS (SELECT *, row_number() OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source) AS place FROM weighed),
        levels AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum({MOST_COPIES} * source_size) OVER w, 0) AS DOUBLE)
                / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level
            FROM sorted WINDOW w AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        one AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= {MOST_COPIES} * source_size),
        targets AS (SELECT source, CAST(source_size AS BIGINT) AS source_size,
                least(CAST({MOST_COPIES} * source_size AS DOUBLE), one.level * weight) AS target FROM weighed, one),
        plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
        keyed0 AS (
            SELECT d.*, p.source_size, p.target, p.whole, CASE WHEN p.source_size > 0 THEN p.target / p.source_size - p.whole ELSE 0 END AS share,
                   p.target - p.whole * p.source_size AS rest
            FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
        sizes AS (SELECT source, size, any_value(rest) AS rest, CAST(count(*) * size AS BIGINT) AS words FROM keyed0 WHERE rest > 0 AND size > 0 GROUP BY source, size),
        summed AS (SELECT *, (rest - CAST(coalesce(sum(words) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
                / CAST(sum(words * size) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS c FROM sizes),
        scales AS (SELECT source, arg_max(c, size) AS scale FROM summed WHERE c * size < 1 GROUP BY source),
        likely AS (SELECT k.*, least(CAST(1 AS DOUBLE), coalesce(s.scale, 0) * size) AS p FROM keyed0 k LEFT JOIN scales s ON k.source IS NOT DISTINCT FROM s.source),
        odds AS (SELECT *, u * (1 - p) * share AS a, (1 - u) * p * (1 - share) AS b FROM likely),
        keyed AS (SELECT *, CASE WHEN share > 0 AND p > 0 THEN floor(a / (a + b) * 281474976710656) END AS key FROM odds),
        {",".join(rounds)},
        last AS (SELECT *, {chosen} AS sampled,
                greatest(rest - coalesce(sum(size) FILTER (WHERE {chosen}) OVER (PARTITION BY source), 0), 0) AS gap FROM r{ROUNDS - 1}),
        near AS (SELECT source, min({{'d': abs(size - gap), 'k': key}}).k AS added FROM last
            WHERE NOT sampled AND share > 0 AND size > 0 AND size < 2 * gap GROUP BY source),
        copied AS (SELECT l.*, CAST(whole + CAST(sampled OR coalesce(key = added, false) AS INTEGER) AS INTEGER) AS copies
            FROM last l LEFT JOIN near n ON l.source IS NOT DISTINCT FROM n.source)
        SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies FROM copied"""


def _archives_sql() -> str:
    """Base32 from five hexadecimal digits at a time: four letters each."""
    parts = ", ".join(f"CAST('0x' || substr(hex, {5 * k + 1}, 5) AS INTEGER) AS v{k}" for k in range(8))
    letters = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v{k} >> {shift}) & 31) + 1, 1)" for k in range(8) for shift in (15, 10, 5, 0))
    return f"""
        WITH sized AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        hashed AS (SELECT *, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS largest FROM sized),
        parts AS (SELECT *, {parts} FROM hashed)
        SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, {letters} AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
        FROM parts"""


#: op1: windows of MIN_RUN lines stand in for the runs: a run of at least that many lines has an earlier copy
#: exactly if each of its windows has one.
ORACLES: dict[str, str] = {
    "op1_line_dedup": rf"""
        WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
        lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
        windows AS (
            SELECT doc_id, pos, list(line) OVER w AS run, count(*) OVER w AS n FROM lines
            WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {MIN_RUN - 1} FOLLOWING)),
        firsts AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth FROM windows WHERE n = {MIN_RUN}),
        copies AS (
            SELECT doc_id, pos, line, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth,
                   count(*) OVER (PARTITION BY doc_id) AS n_lines, len(regexp_extract_all(line, '{WORD_REGEX}')) AS n_words FROM lines),
        gone AS (
            SELECT doc_id, pos + k AS pos FROM firsts, range({MIN_RUN}) AS r(k) WHERE nth > 1
            UNION
            SELECT doc_id, pos FROM copies WHERE nth > 1 AND (n_words >= {PASSAGE_WORDS} OR (n_lines = 1 AND n_words > 0))),
        kept AS (
            SELECT l.doc_id, count(g.pos) AS n_removed, count(*) AS n_lines,
                   coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
            FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
        SELECT doc_id, n_lines, n_removed, sha256(text) AS kept_sha256 FROM kept""",
    "op7_substring_dedup": rf"""
        WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD_REGEX}') AS words FROM documents),
        places AS (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS pos FROM split),
        windows AS (SELECT doc_id, pos, array_to_string(list_slice(words, pos, pos + {WINDOW - 1}), ' ') AS run FROM places),
        later AS (SELECT doc_id, pos FROM (
            SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth FROM windows) t WHERE nth > 1),
        gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, range({WINDOW}) AS r(k)),
        words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split),
        kept AS (
            SELECT w.doc_id, count(g.pos) AS n_removed,
                   string_agg(w.word, ' ' ORDER BY w.pos) FILTER (WHERE g.pos IS NULL) AS text
            FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos GROUP BY w.doc_id)
        SELECT s.doc_id, len(s.words) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id""",
    "op8_source_mixture": _mixture_sql(),
    "op11_warc_archives": _archives_sql(),
}
