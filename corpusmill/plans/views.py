"""Tables of the engine's own shapes, derived from the given tables: in Spark and in SQL.

The given tables hold no file trees, search logs or search pages, so these views give their
rows such a shape. Every view covers the whole table it comes from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.functions import text, tokens
from corpusmill.operators import extract
from corpusmill.sources import state, tree

TOKENS_SQL = r"len(regexp_extract_all({0}, '\p{{L}}+|\p{{N}}{{1,3}}|[^\s\p{{L}}\p{{N}}]'))"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- a file tree ----------------------------------------------------------------------

TREE_SQL = r"""
v_blk AS (
  SELECT *, CAST(floor(doc_id / 20.0) AS BIGINT) AS blk FROM documents
),
v_kind AS (
  SELECT *,
    CASE blk % 50 WHEN 10 THEN 'nul' WHEN 20 THEN 'empty' WHEN 30 THEN 'bad' WHEN 40 THEN 'crlf'
      ELSE 'plain' END AS kind,
    CASE source WHEN 'src7' THEN '.org_src7' WHEN 'src13' THEN 'org_src13.github.io'
      ELSE 'org_' || source END AS dir_name,
    CASE doc_id % 7 WHEN 0 THEN '.git/' WHEN 1 THEN '.github/' WHEN 2 THEN 'docs.gitbook/'
      ELSE 'src/' || lang || '/' END
      || 'f' || doc_id ||
      CASE blk % 10 WHEN 4 THEN '.PY' WHEN 5 THEN '.txt' WHEN 6 THEN '.json' WHEN 7 THEN '.md'
        WHEN 8 THEN '' WHEN 9 THEN '.bin' ELSE '.py' END AS file_path
  FROM v_blk
),
v_body AS (
  SELECT *, CASE kind WHEN 'nul' THEN text || chr(0) WHEN 'empty' THEN ''
    WHEN 'crlf' THEN replace(text, chr(10), chr(13) || chr(10)) || chr(13) ELSE text END AS body
  FROM v_kind
),
v_tree AS (
  SELECT doc_id, dir_name, file_path, kind, body,
    CAST(strlen(body) + CASE kind WHEN 'bad' THEN 1 ELSE 0 END AS BIGINT) AS size,
    regexp_extract(file_path, '[^/]*$') AS name,
    regexp_extract(file_path, '^(.*/)?') AS parent,
    regexp_replace(dir_name, '_', '/') AS project_name,
    substr(regexp_replace(body, '\r\n?', chr(10), 'g'), 1, 5000000) AS lossy
  FROM v_body
)
"""

STRICT_SQL = (
    TREE_SQL
    + r""",
v_strict AS (
  SELECT project_name, file_path, size, sha256(body) AS sha256, CAST("""
    + TOKENS_SQL.format("body")
    + r""" AS BIGINT) AS tokens
  FROM v_tree
  WHERE dir_name NOT LIKE '.%' AND NOT contains(dir_name || '/' || parent, '.git')
    AND file_path LIKE '%.py' AND size <= 5242880 AND kind NOT IN ('nul', 'bad')
)
"""
)

COUNTED_SQL = (
    TREE_SQL
    + r""",
v_projects AS (SELECT DISTINCT dir_name, project_name FROM v_tree WHERE dir_name NOT LIKE '.%'),
v_counted AS (
  SELECT p.project_name,
    CAST(coalesce(sum("""
    + TOKENS_SQL.format("t.lossy")
    + r"""), 0) AS BIGINT) AS tokens,
    count(t.lossy) AS files_processed
  FROM v_projects p LEFT JOIN v_tree t
    ON t.dir_name = p.dir_name AND NOT contains(t.dir_name || '/' || t.parent, '.git')
      AND t.size <= 5242880 AND t.lossy <> ''
  GROUP BY p.project_name
)
"""
)


def tree_table(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, dir_name, file_path, size, content`` with one row per document."""
    doc, body, source = F.col("doc_id"), F.col("text").cast("binary"), F.col("source")
    blk = F.floor(doc / F.lit(20.0)).cast("long")
    folder = (
        F.when(doc % 7 == 0, ".git/")
        .when(doc % 7 == 1, ".github/")
        .when(doc % 7 == 2, "docs.gitbook/")
        .otherwise(F.concat(F.lit("src/"), "lang", F.lit("/")))
    )
    endings = {4: ".PY", 5: ".txt", 6: ".json", 7: ".md", 8: "", 9: ".bin"}
    ending = F.lit(".py")
    for number, value in endings.items():
        ending = F.when(F.col("blk") % 10 == number, value).otherwise(ending)
    case = F.col("blk") % 50
    crlf = F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\r")).cast("binary")
    content = (
        F.when(case == 10, F.concat(body, F.unhex(F.lit("00"))))
        .when(case == 20, F.unhex(F.lit("")))
        .when(case == 30, F.concat(body, F.unhex(F.lit("FF"))))
        .when(case == 40, crlf)
        .otherwise(body)
    )
    directory = (
        F.when(source == "src7", ".org_src7")
        .when(source == "src13", "org_src13.github.io")
        .otherwise(F.concat(F.lit("org_"), source))
    )
    shaped = table(spark, sf, "documents").withColumn("blk", blk)
    return shaped.select(
        "doc_id",
        directory.alias("dir_name"),
        F.concat(folder, F.lit("f"), doc.cast("string"), ending).alias("file_path"),
        content.alias("content"),
    ).select("doc_id", "dir_name", "file_path", F.octet_length("content").cast("long").alias("size"), "content")


_TREES: dict[tuple[str, str], str] = {}


def tree_folder(spark: SparkSession, sf: str) -> str:
    """The same tree as files on shared storage, the input of the tree queries: written by tasks once per
    application, and again if its folder is gone."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TREES or not state.path_exists(spark, _TREES[key]):
        root = staging.new_path(spark, "tree")
        tree.write_tree(tree_table(spark, sf), root).count()
        _TREES[key] = root
    return _TREES[key]


def tree_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_metadata(tree_table(spark, sf), root="/data")


def tree_index(spark: SparkSession, sf: str) -> DataFrame:
    return extract.build_index(tree_metadata(spark, sf))


# --- an index of all documents, for packing -------------------------------------------

INDEX_SQL = (
    r"""
v_index AS (
  SELECT source AS project_name, CAST(doc_id AS VARCHAR) AS file_path, CAST(strlen(text) AS BIGINT) AS size,
    CAST("""
    + TOKENS_SQL.format("text")
    + r""" AS BIGINT) AS tokens, sha256(text) AS sha256
  FROM documents
)
"""
)


def packing_sql(source: str, target: int, low: int, high: int) -> str:
    """The greedy rule as a recursive walk over ``source`` (a view with project, path, size)."""
    return f"""
v_ordered AS (
  SELECT *, row_number() OVER (ORDER BY project_name, file_path) AS rn FROM {source}
),
v_walk AS (
  SELECT rn, size, CAST(0 AS BIGINT) AS shard, size AS held, size >= {target} AS closed
  FROM v_ordered WHERE rn = 1
  UNION ALL
  SELECT n.rn, n.size,
    w.shard + CASE WHEN w.closed OR (w.held > 0 AND w.held >= {low} AND w.held + n.size > {high})
      THEN 1 ELSE 0 END,
    CASE WHEN w.closed OR (w.held > 0 AND w.held >= {low} AND w.held + n.size > {high})
      THEN n.size ELSE w.held + n.size END,
    CASE WHEN w.closed OR (w.held > 0 AND w.held >= {low} AND w.held + n.size > {high})
      THEN n.size ELSE w.held + n.size END >= {target}
  FROM v_walk w JOIN v_ordered n ON n.rn = w.rn + 1
),
v_assigned AS (
  SELECT o.project_name, o.file_path, o.tokens, o.size, o.sha256, w.shard,
    printf('%05d', w.shard) AS shard_id
  FROM v_ordered o JOIN v_walk w USING (rn)
)
"""


def document_index(spark: SparkSession, sf: str) -> DataFrame:
    body = F.col("text")
    return table(spark, sf, "documents").select(
        F.col("source").alias("project_name"),
        F.col("doc_id").cast("string").alias("file_path"),
        tokens.count_tokens(body).alias("tokens"),
        F.octet_length(body).cast("long").alias("size"),
        text.sha256_hex(body.cast("binary")).alias("sha256"),
        F.lit(None).cast("string").alias("shard_id"),
    )


# --- a search log, repositories and search pages --------------------------------------

HITS_SQL = """
v_hits AS (
  SELECT event_type AS query, user_id AS repo_id, event_id AS seq, ts AS found_at, value AS score,
    CAST(1 + floor(event_id / 500.0) AS BIGINT) AS page
  FROM events
)
"""

PAGE_LOG_SQL = (
    HITS_SQL
    + """,
v_first AS (SELECT repo_id, min(seq) AS seq FROM v_hits GROUP BY repo_id),
v_log AS (
  SELECT h.query, h.page, count(*) AS found, count(f.seq) AS new, count(*) - count(f.seq) AS skipped,
    min(h.seq) AS seq
  FROM v_hits h LEFT JOIN v_first f ON f.repo_id = h.repo_id AND f.seq = h.seq
  GROUP BY h.query, h.page
)
"""
)

REPOS_SQL = """
v_repos AS (
  SELECT c_custkey AS repo_id, c_mktsegment || '/' || c_name AS full_name,
    'https://github.com/' || c_mktsegment || '/' || c_name || '.git' AS clone_url,
    CAST(floor(abs(c_acctbal)) AS BIGINT) AS stars
  FROM customer
)
"""

TOPICS_SQL = "v_topics AS (SELECT DISTINCT replace(p_name, ' ', '-') AS topic FROM part)"


def hits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("query"),
        F.col("user_id").alias("repo_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("found_at"),
        F.col("value").alias("score"),
        (F.floor(F.col("event_id") / F.lit(500.0)) + 1).cast("long").alias("page"),
    )


def repos(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("c_mktsegment", F.lit("/"), "c_name")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("repo_id"),
        name.alias("full_name"),
        F.concat(F.lit("https://github.com/"), name, F.lit(".git")).alias("clone_url"),
        F.floor(F.abs("c_acctbal")).cast("long").alias("stars"),
    )


def topic_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.replace("p_name", F.lit(" "), F.lit("-")).alias("topic"))


# Navigation links become result records. Words up to m get a star label, n to s a rounded
# count, the others neither, so they show what a neighbouring record lends them.
_LABELLED = r'<li><a href="/([A-Ma-m][^"/]*)">([^<]*)</a></li>'
_ROUNDED = r'<li><a href="/([N-Sn-s][^"/]*)">([^<]*)</a></li>'
_BARE = r'<li><a href="/([^"/]*)">([^<]*)</a></li>'

SEARCH_SQL = f"""
v_owned AS (
  SELECT page_id, html, CASE page_id % 7 WHEN 3 THEN 'topics' ELSE 'o' || (page_id % 7) END AS owner
  FROM pages
),
v_search AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html,
    '{_LABELLED}',
    '<div class="f4 search-title"><a href="/' || owner || '/\\1">\\2</a></div><a aria-label="' || (page_id % 40) || ' stars">*</a>', 'g'),
    '{_ROUNDED}',
    '<div class="f4 search-title"><a href="/' || owner || '/\\1">\\2</a></div><a href="/' || owner || '/\\1/stargazers" class="s"><span>' || (page_id % 13) || '.5k</span></a>', 'g'),
    '{_BARE}',
    '<div class="f4 search-title"><a href="/' || owner || '/\\1">\\2</a></div>', 'g') AS html
  FROM v_owned
),
v_matched AS (
  SELECT page_id, html,
    regexp_extract_all(html, '(?s)<div[^>]*search-title[^>]*>.*?href="/([^/]+/[^/"]+)"', 0) AS whole,
    regexp_extract_all(html, '(?s)<div[^>]*search-title[^>]*>.*?href="/([^/]+/[^/"]+)"', 1) AS names,
    string_split_regex(html, '(?s)<div[^>]*search-title[^>]*>.*?href="/([^/]+/[^/"]+)"') AS gaps
  FROM v_search
),
v_found AS (
  SELECT page_id, html, whole, names, gaps, unnest(range(1, len(whole) + 1)) AS i FROM v_matched
),
v_placed AS (
  SELECT page_id, html, i - 1 AS position, names[i] AS name,
    list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + list_sum(list_transform(whole[1:i], lambda x: length(x))) AS stop, length(whole[i]) AS len
  FROM v_found
),
v_context AS (
  SELECT page_id, CAST(position AS INTEGER) AS position, name, CAST(stop - len AS INTEGER) AS start,
    CAST(stop AS INTEGER) AS "end",
    substring(html, CAST(greatest(stop - len - 200, 0) + 1 AS BIGINT),
      CAST(stop + 3000 - greatest(stop - len - 200, 0) AS BIGINT)) AS context
  FROM v_placed
),
v_star_text AS (
  SELECT *, TRY_CAST(regexp_extract(context, 'aria-label="(\\d+)\\s+stars"', 1) AS BIGINT) AS label,
    lower(regexp_extract(context, '(?s)href="/[^"]+/stargazers"[^>]*>.*?<span[^>]*>([\\d.]+[kmKM]?)</span>', 1)) AS span
  FROM v_context
),
v_records AS (
  SELECT page_id, position, name, start, "end", context,
    CASE WHEN coalesce(label, 0) <> 0 THEN label
      ELSE coalesce(CAST(trunc(TRY_CAST(regexp_replace(span, '[km]', '') AS DOUBLE)
        * CASE WHEN span LIKE '%k%' THEN 1000.0 WHEN span LIKE '%m%' THEN 1000000.0 ELSE 1.0 END) AS BIGINT), 0)
      END AS stars
  FROM v_star_text
)
"""


def search_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    page = F.col("page_id")
    owner = F.when(page % 7 == 3, "topics").otherwise(F.concat(F.lit("o"), (page % 7).cast("string")))
    title = [F.lit('<div class="f4 search-title"><a href="/'), owner, F.lit('/$1">$2</a></div>')]
    labelled = F.concat(*title, F.lit('<a aria-label="'), (page % 40).cast("string"), F.lit(' stars">*</a>'))
    rounded = F.concat(
        *title,
        F.lit('<a href="/'),
        owner,
        F.lit('/$1/stargazers" class="s"><span>'),
        (page % 13).cast("string"),
        F.lit(".5k</span></a>"),
    )
    html = F.col("html")
    for pattern, text_ in ((_LABELLED, labelled), (_ROUNDED, rounded), (_BARE, F.concat(*title))):
        html = F.regexp_replace(html, F.lit(pattern), text_)
    return pages.select("page_id", html.alias("html"))
