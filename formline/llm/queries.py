"""The thin queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.llm import collocations, curriculum, language, licenses, packing, parity_join, pivot_index, posting_search, prefix_trie, secrets, sharding, token_prefixes, warc
from formline.operators.layout import stored


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Gives the executors' Python this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="formline-")) / "formline.zip"  # the driver's copy, which it sends out
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted((root / "formline").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Hands long texts to Python in small batches: an executor's workers share what its heap leaves."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            small_batches(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op4_curriculum")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Documents mixed to the weights 5, 2, 1 of their sources, in training order."""
    docs = table(spark, folder, "documents").select("doc_id", "source", curriculum.word_count(F.col("text")).alias("size"))
    plan = curriculum.curriculum_plan(docs)
    first = F.try_element_at("positions", F.lit(1))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", first.alias("first_position")) \
        .orderBy(F.asc_nulls_last("first_position"), "doc_id")


@query("op10_sharding")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Documents dealt uniformly to 24 shards whose row counts differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = sharding.shard_uniformly(docs, 24, seed=20)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


# Exact as the join is; SQL lists every pair of documents with a common shingle.
JACCARD_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (min(a.n) + min(b.n) - count(*))),
reach AS (SELECT a AS start, b AS node FROM links UNION SELECT start, b FROM reach JOIN links ON node = a),
least AS (SELECT start, min(node) AS node FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(node, doc_id)) AS component_id
FROM sets LEFT JOIN least ON start = doc_id"""


@query("op5_jaccard_join", JACCARD_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked by a shingle similarity of 0.75 or more."""
    return parity_join.near_duplicates(table(spark, folder, "documents"))


@query("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, folder, "documents")
    found = language.predict(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op1_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens packed into sequences of at most 4096."""
    packed = packing.pack_documents(table(spark, folder, "documents"), tokenizer_file(packing.TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bins", "bound")


@query("op2_secrets")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document: fixed patterns and incompressible strings."""
    found = secrets.secret_spans(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda s: s["kind"] != "novel")
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]],
                        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("secret_spans")).alias("spans"),
                        count("novel").alias("n_novel"))


# Five hexadecimal digits of the SHA-1 are four letters of base 32.
WARC_SQL = """
WITH payloads AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT *, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
SELECT page_id, url, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
    (CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS INTEGER), 1) FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests"""


@query("op3_warc", WARC_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    found = warc.archived(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query("op6_licenses")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    found = licenses.license_notices(table(spark, folder, "documents").select("doc_id", "text"))
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return found.select("doc_id", *[F.col(f"license.{name}").alias(name) for name in names])


@query("op8_embedding_duplicates")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of embeddings linked by a cosine of 0.9 or more."""
    return pivot_index.near_duplicate_vectors(table(spark, folder, "embeddings"))


@query("op9_nearest")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest embeddings of every 50th one."""
    rows = table(spark, folder, "embeddings")
    found = posting_search.nearest_neighbours(rows, rows.filter("vec_id % 50 = 0"))
    return found.withColumnRenamed("id", "vec_id")


@query("op13_token_counts")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and of its longest prefix within 4096 of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    found = token_prefixes.token_prefixes(docs, tokenizer_file(token_prefixes.MODEL), limit=token_prefixes.LIMIT)
    return found.select("doc_id", "n_bytes", "tokens.n_tokens", (F.col("tokens.n_tokens") > token_prefixes.LIMIT).alias("over_limit"),
                        "tokens.cut_chars", "tokens.cut_tokens")


# The checksum bit by bit: a byte is mixed in, then eight steps of -1 shift it out.
TRIE_SQL = r"""
WITH checked AS (
  SELECT DISTINCT conv_id, list_reduce(list_concat([4294967295::BIGINT], flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN
    string_split(CAST(conv_id AS VARCHAR), '')])), lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS rest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place FROM conversations),
ids AS (SELECT conv_id, xor(rest, 4294967295) % 4 AS h, conv_id - conv_id % 20 AS base FROM checked),
rebuilt AS (
  SELECT i.conv_id, 0 AS part, o.place, role, text FROM ids i JOIN own o ON o.conv_id = base AND o.place <= h
  UNION ALL SELECT i.conv_id, 1, o.place, role, text FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.place > h),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS d,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt),
steps AS (
  SELECT conv_id, d, words, sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS key FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
nodes AS (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n, min(words) AS words FROM steps GROUP BY ALL),
linked AS (
  SELECT n.*, p.key AS parent_key, q.conv_id AS parent_id FROM nodes n LEFT JOIN steps p ON p.conv_id = n.conv_id AND p.d = n.d - 1
  LEFT JOIN nodes q ON q.d = p.d AND q.key = p.key),
children AS (SELECT d - 1 AS d, parent_key AS key, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT s.d, s.key, sum((n.n - 1) * n.words) AS saved, count(*) FILTER (c.n_children IS NULL) AS leaves
  FROM nodes n JOIN steps s ON s.conv_id = n.conv_id AND s.d <= n.d LEFT JOIN children c ON c.d = n.d AND c.key = n.key GROUP BY ALL),
ends AS (
  SELECT s.d, s.key, string_agg(CAST(s.conv_id AS VARCHAR), ',' ORDER BY s.conv_id) AS found
  FROM steps s JOIN (SELECT conv_id, max(d) AS d FROM steps GROUP BY 1) USING (conv_id, d) GROUP BY ALL)
SELECT l.conv_id, CAST(l.d AS BIGINT) AS depth, l.parent_id AS parent_conv_id, CAST(n AS BIGINT) AS n_convs,
  CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(found, '')) AS ends_sha256
FROM linked l JOIN below b ON b.d = l.d AND b.key = l.key LEFT JOIN children c ON c.d = l.d AND c.key = l.key LEFT JOIN ends e ON e.d = l.d AND e.key = l.key"""


@query("op12_prefix_trie", TRIE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, rebuilt to begin with up to three turns of every twentieth one."""
    told = stored(prefix_trie.conversation_turns(table(spark, folder, "conversations"), curriculum.word_count(F.col("text"))), "turns")
    heads = told.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    own = told.select("conv_id", "turns", (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rebuilt = F.concat(first, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    return prefix_trie.prefix_trie(own.join(heads, "base", "left").select("conv_id", rebuilt.alias("turns")))


COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang),
counts AS (
  SELECT lang, g, count(*) AS a FROM (
    SELECT lang, unnest(flatten([[w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)] FOR k IN range(1, 5)])) AS g FROM worded)
  GROUP BY lang, g HAVING count(*) >= 30),
phrases AS (SELECT * FROM counts WHERE len(g) > 1),
cuts AS (SELECT *, unnest(range(1, len(g))) AS cut FROM phrases),
scored AS (
  SELECT c.lang, c.g, c.a, c.cut, l.a AS l, r.a AS r, CAST(2000000::HUGEINT * c.a // (l.a + r.a) AS BIGINT) AS score FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.g = c.g[1:cut] JOIN counts r ON r.lang = c.lang AND r.g = c.g[cut + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
around AS (
  SELECT lang, g, max(a) AS longer FROM (
    SELECT lang, a, unnest(flatten([[g[i:i + k - 1] FOR i IN range(1, len(g) - k + 2)] FOR k IN range(2, len(g))])) AS g FROM phrases WHERE len(g) > 2)
  GROUP BY ALL),
kept AS (
  SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.g = b.g
  WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < 80::HUGEINT * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000"""


@query("op11_collocations", COLLOCATION_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 best phrases of every language."""
    return collocations.collocations(table(spark, folder, "documents"))
