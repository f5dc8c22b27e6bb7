"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import (
    decontaminate,
    language_id,
    licenses,
    periodic_runs,
    piece_codec,
    quality_knn,
    quality_rules,
    ring_shards,
    secret_scan,
    simhash,
    sliced_search,
    substrings,
    warc,
)
from corpusmill.llm.common import table

#: A SentencePiece model with byte fallback.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES = {}
ORACLE = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def held_out(doc_id: Column) -> Column:
    """Whether a row may not be learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


@query
def op1_sentencepiece(spark: SparkSession, sf: str, tokenizer: str = TOKENIZER) -> DataFrame:
    codec = piece_codec.load(piece_codec.read_model(spark, tokenizer))
    documents = table(spark, sf, "documents").select("doc_id", "text")
    coded = piece_codec.encode(documents, codec, keep=["doc_id"], verify=True)
    return coded.select("row.doc_id", *(f"result.{n}" for n in ("ids", "n_tokens", "n_byte_tokens", "decoded_sha256", "exact")))


@query
def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(documents, table(spark, sf, "benchmark"), keep=["doc_id"])
    return found.select(
        "row.doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.transform("leaks", lambda x: x.item).alias("items"),
        F.coalesce(F.array_max(F.transform("leaks", lambda x: x.covered)), F.lit(0.0)).alias("covered"),
        F.transform("leaks", lambda x: F.size(x.tiles)).alias("n_tiles"),
    )


@query
def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf, "documents"))
    span = F.transform("removed", lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string")))
    return found.select(
        F.col("row").getField("doc_id").alias("doc_id"),
        F.col("kept").alias("text"),
        F.size("removed").alias("n_removed"),
        F.array_join(span, ",").alias("removed"),
    )


OP4_SQL = """
WITH digested AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1
      AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digested
"""


@query
def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = staging.new_path(spark, "warc")
    warc.write_warc(table(spark, sf, "pages"), folder)
    found = warc.page_records(warc.read_warc(spark, folder))
    return found.select(
        F.col("id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


ORACLE["op4_warc"] = OP4_SQL


@query
def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf, "documents"), keep=["doc_id"])
    span = F.transform(
        "result.spans", lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    )
    return found.select(
        "row.doc_id",
        "result.n_assign",
        "result.n_access",
        "result.n_hex",
        F.sha2(F.col("result.base_spans").cast("binary"), 256).alias("base_sha256"),
        F.array_join(span, ",").alias("spans"),
        "result.n_novel",
    )


@query
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf, "documents"), keep=["doc_id"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *(f"result.{n}" for n in names), "base_failed", "kept", "posterior")


@query
def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    outside = held_out(F.col("doc_id"))
    filters = language_id.learn(documents.where(~outside))
    found = language_id.identify(documents.select("doc_id", "text"), filters, keep=["doc_id"])
    return found.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        F.col("result.lang").alias("lang_pred"),
        "result.score",
    )


def quality_model(spark: SparkSession, sf: str, documents: DataFrame) -> quality_knn.Model:
    """Learned from the labelled rows of ``documents`` that are not held out."""
    labels = table(spark, sf, "labels").where(~held_out(F.col("doc_id")))
    return quality_knn.learn(documents, labels)


@query
def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op9_quality_knn(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    model = quality_model(spark, sf, documents)
    found = quality_knn.classify(documents.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "result.score",
        (F.col("result.score") >= quality_knn.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf, "documents"), keep=["doc_id"])
    own = F.transform("result.spans", lambda s: s.label)
    return found.select(
        "row.doc_id",
        *(f"result.{n}" for n in ("n_words", "n_base", "first_word", "last_word")),
        F.array_join("result.base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("result.base_labels", own)), ",").alias("labels"),
        "result.score",
    )


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, terms, len(terms) AS n
  FROM (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents)
  WHERE len(terms) > 0
), asked AS (
  SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), counts AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, term
), totals AS (
  SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM docs
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, all_docs
), scored AS (
  SELECT item, item_id, row, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN docs USING (row), totals
  GROUP BY item, item_id, row, doc_id
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


@query
def op11_sliced_search(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    index = staging.stage(sliced_search.build_index(documents), "search-index")
    found = sliced_search.search(documents, index, table(spark, sf, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


ORACLE["op11_sliced_search"] = OP11_SQL


#: CRC-32 byte by byte over the hexadecimal digits of the UTF-8 text; polynomial 0xEDB88320.
OP12_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS codes
), points AS (
  SELECT row_number() OVER (ORDER BY place, shard) - 1 AS node, place, shard,
    row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS part
  FROM (SELECT i % 40 AS shard, CAST('0x' || substr(md5('shard-' || (i % 40) || '-' || (i // 40)), 1, 15) AS BIGINT) AS place
        FROM range(40 * 64) t(i))
), docs AS (
  SELECT doc_id, strlen(body) + 16 AS size, hex(encode(body)) AS digits,
    CAST('0x' || substr(md5(body), 1, 15) AS BIGINT) AS place, CAST('0x' || substr(md5(body), 16, 15) AS BIGINT) AS rank
  FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
), homed AS (
  SELECT doc_id, size, digits, rank, coalesce(p.node, z.node) AS node, coalesce(p.shard, z.shard) AS home
  FROM docs d ASOF LEFT JOIN points p ON d.place <= p.place, (SELECT node, shard FROM points WHERE node = 0) z
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY home ORDER BY rank, doc_id) - 1 AS slot FROM homed
), loads AS (
  SELECT s AS shard, least(n, capacity) AS own, capacity - least(n, capacity) AS room
  FROM (SELECT s, (SELECT count(*) FROM ranked WHERE home = s) AS n,
          total // 40 + CASE WHEN s < total % 40 THEN 1 ELSE 0 END AS capacity
        FROM range(40) t(s), (SELECT count(*) AS total FROM documents))
), filled AS (
  SELECT node, p.shard, coalesce(e.over, 0) AS over, room // 64 + CASE WHEN part < room % 64 THEN 1 ELSE 0 END AS spare
  FROM points p JOIN loads USING (shard)
  LEFT JOIN (SELECT node, count(*) AS over FROM ranked r JOIN loads l ON l.shard = r.home WHERE slot >= own GROUP BY node) e
    USING (node)
), summed AS (
  SELECT *, sum(over - spare) OVER (ORDER BY round, node) AS so_far
  FROM filled, (SELECT unnest([0, 1]) AS round)
), passing AS (
  SELECT *, so_far - least(0, min(so_far) OVER (ORDER BY round, node)) AS on_ FROM summed
), taking AS (
  SELECT *, coalesce(lag(on_) OVER (ORDER BY round, node), 0) + over - on_ AS taken FROM passing
), flows AS (
  SELECT node, shard, taken, (node - min(node) FILTER (on_ = 0) OVER () + 2 * 2560 - 1) % 2560 AS turn
  FROM taking WHERE round = 1
), offers AS (
  SELECT shard, own + coalesce(within, 0) AS first, upto - taken AS low, upto AS high
  FROM (SELECT shard, taken, sum(taken) OVER (ORDER BY turn) AS upto,
          sum(taken) OVER (PARTITION BY shard ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS within
        FROM flows) JOIN loads USING (shard)
  WHERE taken > 0
), waiting AS (
  SELECT doc_id, size, digits, row_number() OVER (ORDER BY turn, rank, doc_id) - 1 AS unit
  FROM ranked r JOIN loads l ON l.shard = r.home JOIN flows f ON f.node = r.node
  WHERE slot >= own
), placed AS (
  SELECT doc_id, size, digits, home AS shard, slot FROM ranked r JOIN loads l ON l.shard = r.home WHERE slot < own
  UNION ALL
  SELECT doc_id, size, digits, shard, first + unit - low FROM waiting JOIN offers ON unit >= low AND unit < high
)
SELECT doc_id, CAST(size AS BIGINT) AS size,
  CAST(xor(list_reduce(list_prepend(4294967295, range(CAST(size - 16 AS BIGINT))), lambda c, i:
    xor(c >> 8, codes[(xor(c & 255, CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT)) & 255) + 1])), 4294967295) AS BIGINT)
    AS text_crc32,
  'rows' AS law, CAST(shard AS INT) AS shard, CAST(slot AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM placed, crc
"""


@query
def op12_ring_shards(spark: SparkSession, sf: str) -> DataFrame:
    placed = ring_shards.place_documents(table(spark, sf, "documents").select("doc_id", "text"))
    return placed.select(
        "row.doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


ORACLE["op12_ring_shards"] = OP12_SQL


def looped_text(doc_id: Column, text: Column) -> Column:
    """The text of every document, but a tenth of them repeat a stretch of their words to the end."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[ \\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    turns = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), turns)), 1, n - a)
    looped = F.concat(F.slice(words, 1, a), tail)
    return F.when((h % 10 == 0) & text.rlike("[^ \\x09-\\x0D]"), F.array_join(looped, " ")).otherwise(text)


@query
def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    looped = documents.select("doc_id", looped_text(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(looped, keep=["doc_id"])
    line = F.transform("result.runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "row.doc_id",
        F.size("result.runs").cast("long").alias("n_runs"),
        "result.best.start",
        "result.best.length",
        "result.best.period",
        F.expr("(1000 * result.best.length) div result.best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("result.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
