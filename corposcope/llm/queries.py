"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import exact_dedup, language, licences, mixing, packing, prefix_trie, secrets, simhash, sketches, substring_dedup, toxicity, warc, whitening
from .common import LOWER, UPPER, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = language.fit(docs.where(~language.held_out()))
    found = language.with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op2_licence_scan")
def licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan_licences(documents(spark, folder).select("doc_id", "text"))


@query("op3_simhash_dedup")
def simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id", "links")


@query("op4_pack_documents")
def pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(documents(spark, folder), packing.tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op5_mix_sources")
def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    sized = mixing.with_sizes(documents(spark, folder)).select("doc_id", "source", "size")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing.mix_sources(sized).select("doc_id", "size", "source_size", "target", taken, "copies", "rate")


@query(
    "op9_exact_dedup",
    f"""
    WITH texts AS (
      SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
    )
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM texts WINDOW w AS (PARTITION BY t)
    """,
)
def exact_dedup_(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


@query("op6_fingerprints")
def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.compare_edits(documents(spark, folder))


@query("op7_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.with_secrets(documents(spark, folder).select("doc_id", "text"))

    def of(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(secrets.spelled(base), 256).alias("base_sha256"), secrets.spelled("secrets").alias("spans"),
    )


@query(
    "op8_substring_dedup",
    """
    WITH texts AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), windows AS (
      SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM texts)
    ), repeated AS (
      SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS least FROM windows) WHERE least < doc_id
    ), gone AS (
      SELECT doc_id, list(DISTINCT p + i) AS places FROM repeated, (SELECT unnest(range(0, 13)) AS i) GROUP BY doc_id
    ), kept AS (
      SELECT doc_id, ws, [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(coalesce(places, []), i)] AS ks
      FROM texts LEFT JOIN gone USING (doc_id)
    )
    SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - len(ks))::BIGINT AS n_removed, sha256(coalesce(array_to_string(ks, ' '), '')) AS kept_sha256
    FROM kept
    """,
)
def substring_dedup_(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(documents(spark, folder))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op10_toxicity")
def toxicity_(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learnt = toxicity.fit(docs.where(~toxicity.held_out()), labels.where(~toxicity.held_out()))
    return toxicity.with_toxicity(docs, learnt).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query(
    "op11_warc_archives",
    """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS b FROM pages),
    kept AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keep FROM payloads),
    told AS (SELECT *, b >= 1000 AND keep IS NOT NULL AND page_id IS DISTINCT FROM keep AS again FROM kept)
    SELECT page_id, b::BIGINT AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN again THEN keep END AS refers_to
    FROM told
    """,
)
def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(spark.read.parquet(f"{folder}/pages.parquet")).drop("target_uri")


@query("op12_whitening")
def whitening_(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))


# crc32 by its polynomial, a bit at a time: the digits of an id are few.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


@query(
    "op13_prefix_trie",
    f"""
    WITH own AS (
      SELECT conv_id, list(coalesce(role, '') ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS roles,
        list(coalesce(text, '') ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS texts
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ), turned AS (SELECT conv_id, list_transform(list_zip(roles, texts), lambda z: {{'role': z[1], 'text': z[2]}}) AS ts FROM own
    ), planned AS (SELECT conv_id, ts, conv_id - conv_id % 20 AS base, ({_CRC} % 4)::BIGINT AS h FROM turned
    ), rebuilt AS (
      SELECT p.conv_id, list_concat(coalesce(b.ts[1:p.h], []), p.ts[p.h + 1:]) AS ts FROM planned p LEFT JOIN turned b ON b.conv_id = p.base
    ), members AS (
      SELECT conv_id, len(ts)::BIGINT AS n, unnest(range(0, len(ts) + 1)) AS depth, ts FROM rebuilt
    ), paths AS (
      SELECT conv_id, n, depth, sha256(ts[1:depth]::VARCHAR) AS path, CASE WHEN depth > 0 THEN sha256(ts[1:depth - 1]::VARCHAR) END AS above,
        CASE WHEN depth > 0 THEN len(regexp_extract_all(ts[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
      FROM members
    ), nodes AS (
      SELECT depth, path, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
      FROM paths GROUP BY depth, path
    ), children AS (SELECT depth - 1 AS depth, above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
    ), counted AS (
      SELECT n.*, coalesce(c.n_children, 0) AS n_children, (n.n_convs - 1) * n.words AS saved FROM nodes n LEFT JOIN children c USING (depth, path)
    ), subtrees AS (
      SELECT p.depth, p.path, sum(c.saved) AS saved_tokens, count(*) FILTER (WHERE c.n_children = 0) AS n_leaves
      FROM (SELECT DISTINCT c.conv_id AS least, c.depth AS low FROM counted c) k
      JOIN counted c ON c.conv_id = k.least AND c.depth = k.low
      JOIN paths p ON p.conv_id = k.least AND p.depth <= k.low
      GROUP BY p.depth, p.path
    )
    SELECT n.conv_id, n.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM counted n JOIN subtrees s USING (depth, path) LEFT JOIN counted a ON a.depth = n.depth - 1 AND a.path = n.above
    """,
)
def prefix_trie_(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))
