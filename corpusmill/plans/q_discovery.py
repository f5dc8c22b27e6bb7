"""Queries over search grids, hits, page logs, landed pages and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill import constants as C
from corpusmill import staging
from corpusmill.functions import html as H
from corpusmill.functions import search
from corpusmill.operators import discovery as D
from corpusmill.operators import repo_stats
from corpusmill.operators.ordering import running_sums
from corpusmill.plans import views as V
from corpusmill.plans.registry import query
from corpusmill.schemas import PROGRESS
from corpusmill.sinks import bucketed, keyed
from corpusmill.sources import state


def _values(items) -> str:
    return ", ".join("('" + str(i).replace("'", "''") + "')" for i in items)


def _sql(*views: str) -> str:
    return "WITH " + ", ".join(v.strip() for v in views)


# --- topics and grids -----------------------------------------------------------------


@query("topics_distinct", _sql(V.TOPICS_SQL) + " SELECT topic FROM v_topics")
def topics_distinct(spark, sf):
    path = staging.new_path(spark, "topics")
    V.topic_words(spark, sf).write.text(path)
    return state.read_topics(spark, path)


def _grid_sql(ranges, templates) -> str:
    return (
        _sql(V.TOPICS_SQL)
        + f""", v_sorts(sort) AS (VALUES {_values(C.SORTS)}), v_ranges(stars) AS (VALUES {_values(ranges)}),
        v_templates(t) AS (VALUES {_values(templates)}),
        v_grid AS (SELECT topic, sort, stars, replace(replace(t, '{{topic}}', topic), '{{stars}}', stars) AS query
          FROM v_topics, v_sorts, v_ranges, v_templates)
        """
    )


@query(
    "query_grid_searcher",
    _grid_sql(C.API_STAR_RANGES, C.API_TEMPLATES)
    + "SELECT topic, sort, stars, query, query || '|' || sort AS query_key FROM v_grid",
)
def query_grid_searcher(spark, sf):
    return D.api_queries(state.topics(V.topic_words(spark, sf)))


@query(
    "query_grid_scraper",
    _grid_sql(C.WEB_STAR_RANGES, C.WEB_TEMPLATES)
    + "SELECT topic, sort, stars, query, query || '|' || sort AS query_key FROM v_grid",
)
def query_grid_scraper(spark, sf):
    return D.web_queries(state.topics(V.topic_words(spark, sf)))


def _crawl_sql(current: int) -> str:
    """Views ending in ``v_crawl``, the queries of one threshold."""
    return f"""t AS (SELECT topic, row_number() OVER (ORDER BY topic) AS position FROM v_topics),
    lv(level) AS (SELECT CAST(column0 AS BIGINT) FROM (VALUES {_values(C.STAR_LEVELS)}) x(column0)),
    rg AS (SELECT level, lag(level) OVER (ORDER BY level DESC) - 1 AS upper,
      row_number() OVER (ORDER BY level DESC) - (SELECT count(*) FROM lv WHERE level > {current}) AS tier FROM lv),
    r AS (SELECT tier, CASE WHEN upper IS NULL THEN '>=' || level ELSE level || '..' || upper END AS stars,
      CASE WHEN upper IS NULL THEN level || '+' ELSE level || '-' || upper END AS label FROM rg WHERE tier BETWEEN 1 AND 3),
    s(sort, sort_label) AS (VALUES ('stars', 'most stars'), ('updated', 'recently updated'), ('forks', 'most forks')),
    b(topic) AS (VALUES {_values(C.CRAWL_BROAD_TOPICS)}), y(year) AS (VALUES {_values(C.CRAWL_YEARS)}),
    k(topic) AS (VALUES {_values(C.CRAWL_CORE_TOPICS)}), w(word) AS (VALUES {_values(C.CRAWL_README_WORDS)}),
    li(license) AS (VALUES {_values(C.CRAWL_LICENSES)}), z(size) AS (VALUES {_values(C.CRAWL_SIZES)}),
    f(filename) AS (VALUES {_values(C.CRAWL_FILENAMES)}),
    a(topic, short) AS (VALUES ('machine-learning', 'ML'), ('deep-learning', 'DL'))
    , v_crawl AS (SELECT 'topic' AS family, 'language:python topic:' || topic || ' stars:' || stars AS query,
      'ML/DL: ' || topic || ' (' || label || ' stars, ' || sort_label || ')' AS description, sort, 'desc' AS "order" FROM t, r, s
    UNION ALL SELECT 'recent', 'language:python topic:' || topic || ' stars:' || stars || ' pushed:>2023-01-01',
      'Recent: ' || topic || ' (' || label || ' stars, updated 2023+)', 'updated', 'desc' FROM t, r WHERE position <= 15 AND tier <= 2
    UNION ALL SELECT 'broad', 'language:python ' || topic || ' stars:' || stars,
      'Broad: ' || topic || ' (' || label || ' stars, ' || sort_label || ')', sort, 'desc' FROM b, r, s
    UNION ALL SELECT 'year', 'language:python ' || topic || ' stars:' || stars || ' created:' || year,
      'Year ' || year || ': ' || topic || ' (' || label || ' stars)', 'stars', 'desc' FROM y, k, r WHERE tier <= 2
    UNION ALL SELECT 'readme', 'language:python "' || word || '" in:readme stars:' || stars,
      'README: "' || word || '" (' || label || ' stars)', 'stars', 'desc' FROM w, r WHERE tier <= 2
    UNION ALL SELECT 'license', 'language:python machine-learning stars:' || stars || ' license:' || license,
      'License ' || license || ': ML (' || label || ' stars)', 'stars', 'desc' FROM li, r WHERE tier <= 2
    UNION ALL SELECT 'size', 'language:python machine-learning size:' || size,
      'Large repos: size ' || size || 'KB (' || sort_label || ')', sort, 'desc' FROM z, s WHERE sort <> 'forks'
    UNION ALL SELECT 'filename', 'language:python filename:' || filename || ' stars:' || stars,
      'Filename ' || filename || ' (' || label || ' stars)', 'stars', 'desc' FROM f, r WHERE tier <= 2
    UNION ALL SELECT 'archived', 'language:python ' || topic || ' stars:' || stars || ' archived:true',
      'Archived ' || short || ' repos (' || label || ' stars)', 'stars', 'desc' FROM a, r WHERE tier <= 2)"""


@query("query_grid_crawler", _sql(V.TOPICS_SQL) + ", " + _crawl_sql(C.STAR_LEVELS[0]) + " SELECT * FROM v_crawl")
def query_grid_crawler(spark, sf):
    topics = running_sums(state.topics(V.topic_words(spark, sf)), ["topic"], {"position": None})
    return D.crawl_queries(topics, current=C.STAR_LEVELS[0])


@query(
    "pending_queries",
    _grid_sql(C.API_STAR_RANGES, C.API_TEMPLATES)
    + """, v_done AS (SELECT DISTINCT replace(p_name, ' ', '-') AS topic FROM part WHERE p_size > 45)
    SELECT query, sort, query || '|' || sort AS query_key FROM v_grid
    WHERE NOT (sort = 'stars' AND topic IN (SELECT topic FROM v_done))""",
)
def pending_queries(spark, sf):
    grid = query_grid_searcher(spark, sf).select("topic", "query", "sort", "query_key")
    large = V.table(spark, sf, "part").filter("p_size > 45")
    run = large.select(F.replace("p_name", F.lit(" "), F.lit("-")).alias("topic")).distinct()
    done = grid.filter("sort = 'stars'").join(run, "topic", "left_semi").select("query_key")
    return D.pending(grid.drop("topic"), done, "query_key")


_LEVELS_SQL = "v_levels AS (SELECT DISTINCT stars // 1000 * 1000 AS level FROM v_repos)"


def _levels(spark, sf):
    thousand = F.col("stars") - F.col("stars") % 1000
    return V.repos(spark, sf).select(thousand.alias("level")).distinct()


@query(
    "star_ranges",
    _sql(V.REPOS_SQL, _LEVELS_SQL)
    + """, v_ranged AS (SELECT level, lag(level) OVER (ORDER BY level DESC) - 1 AS upper,
        row_number() OVER (ORDER BY level DESC) AS tier FROM v_levels)
    SELECT level, upper, CAST(tier AS INTEGER) AS tier,
      CASE WHEN upper IS NULL THEN '>=' || level ELSE level || '..' || upper END AS stars,
      (SELECT count(*) FROM v_repos r WHERE r.stars // 1000 * 1000 = level) AS repos FROM v_ranged""",
)
def star_ranges(spark, sf):
    thousand = F.col("stars") - F.col("stars") % 1000
    counted = V.repos(spark, sf).groupBy(thousand.alias("level")).agg(F.count(F.lit(1)).alias("repos"))
    return D.star_ranges(_levels(spark, sf)).join(counted, "level")


# --- hits -----------------------------------------------------------------------------


@query(
    "first_seen",
    _sql(V.HITS_SQL)
    + """ SELECT query, repo_id, seq, page FROM
      (SELECT *, row_number() OVER (PARTITION BY repo_id ORDER BY seq) AS rn FROM v_hits) WHERE rn = 1""",
)
def first_seen(spark, sf):
    return D.first_seen(V.hits(spark, sf).select("query", "repo_id", "seq", "page"), "repo_id", ["seq"])


@query(
    "new_hits",
    """SELECT o_custkey AS repo_id, min(o_orderkey) AS seq FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey""",
)
def new_hits(spark, sf):
    found = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("repo_id"), F.col("o_orderkey").alias("seq"))
    customers = V.table(spark, sf, "customer").withColumnRenamed("c_custkey", "repo_id")
    seen, cloned = customers.filter("c_acctbal < 0"), customers.filter("c_mktsegment = 'BUILDING'")
    return D.new_hits(found, seen, cloned, "repo_id", ["seq"])


@query(
    "new_hits_bucketed",
    """SELECT o_custkey AS repo_id, min(o_orderkey) AS seq FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey""",
)
def new_hits_bucketed(spark, sf):
    """The same against seen and cloned tables in buckets, the seen one added to in a second step."""
    found = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("repo_id"), F.col("o_orderkey").alias("seq"))
    customers = V.table(spark, sf, "customer").withColumnRenamed("c_custkey", "repo_id")
    seen, cloned = staging.new_path(spark, "seen"), staging.new_path(spark, "cloned")
    debtors = customers.filter("c_acctbal < 0").select("repo_id")
    bucketed.create(debtors.filter("repo_id % 2 = 0"), seen, "repo_id", 8)
    bucketed.create(customers.filter("c_mktsegment = 'BUILDING'").select("repo_id"), cloned, "repo_id", 8)
    bucketed.add_unseen(debtors, seen)
    return bucketed.unseen(D.first_seen(found, "repo_id", ["seq"]), seen, cloned)


_MERGE_SQL = """, v_old AS (SELECT full_name, clone_url, stars FROM v_repos WHERE stars >= 4000),
v_new AS (SELECT full_name, clone_url, stars + 1 AS stars FROM v_repos)"""


@query(
    "hits_merge",
    _sql(V.REPOS_SQL)
    + _MERGE_SQL
    + """ SELECT * FROM v_old UNION ALL
    SELECT * FROM v_new WHERE full_name NOT IN (SELECT full_name FROM v_old)""",
)
def hits_merge(spark, sf):
    repos = V.repos(spark, sf).select("full_name", "clone_url", "stars")
    later = repos.withColumn("stars", F.col("stars") + 1)
    return D.merge_hits(repos.filter("stars >= 4000"), later)


@query(
    "repos_upsert",
    _sql(V.REPOS_SQL)
    + """, v_all AS (
      SELECT full_name, TIMESTAMP '1990-01-01 00:00:00' AS cloned_at, stars, CAST(-1 AS BIGINT) AS size FROM v_repos
      UNION ALL SELECT r.full_name, o.o_orderdate, CAST(floor(o.o_totalprice) AS BIGINT), o.o_orderkey
        FROM orders o JOIN v_repos r ON r.repo_id = o.o_custkey)
    SELECT full_name, stars, size FROM
      (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY cloned_at DESC, size DESC) AS rn FROM v_all) WHERE rn = 1""",
)
def repos_upsert(spark, sf):
    repos = V.repos(spark, sf)
    stored = repos.select(
        "full_name",
        F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("cloned_at"),
        "stars",
        F.lit(-1).cast("long").alias("size"),
    )
    orders = V.table(spark, sf, "orders").withColumnRenamed("o_custkey", "repo_id")
    updates = orders.join(repos.select("repo_id", "full_name"), "repo_id").select(
        "full_name",
        F.col("o_orderdate").cast("timestamp_ntz").alias("cloned_at"),
        F.floor("o_totalprice").cast("long").alias("stars"),
        F.col("o_orderkey").alias("size"),
    )
    path = staging.new_path(spark, "repos")
    keyed.create(stored, path, "full_name", 8)
    latest = staging.stage(updates, "updates")
    keyed.upsert(latest, path, lambda old, new: repo_stats.upsert_repos(old, new, ["cloned_at", "size"]))
    return keyed.read(spark, path).drop("cloned_at")


@query("page_counts", _sql(V.PAGE_LOG_SQL) + " SELECT query, page, found, new, skipped FROM v_log")
def page_counts(spark, sf):
    return D.page_counts(V.hits(spark, sf), "repo_id", ["seq"])


@query(
    "query_repo_edges",
    _sql(V.HITS_SQL, V.REPOS_SQL)
    + """, v_edges AS (SELECT query, page, repo_id, row_number() OVER (PARTITION BY query, page ORDER BY seq) - 1 AS position
      FROM v_hits)
    SELECT e.query, e.page, CAST(e.position AS INTEGER) AS position, CAST(e.repo_id AS VARCHAR) AS repo_id, r.full_name
    FROM v_edges e JOIN v_repos r USING (repo_id)""",
)
def query_repo_edges(spark, sf):
    """Result pages with their id arrays; a page holds at most the hits of 500 events."""
    ids = F.sort_array(F.collect_list(F.struct("seq", F.col("repo_id").cast("string").alias("id"))))
    results = V.hits(spark, sf).groupBy("query", "page").agg(ids["id"].alias("repo_ids"))
    repos = V.repos(spark, sf).withColumn("repo_id", F.col("repo_id").cast("string"))
    return D.query_repo_edges(results, repos)


@query(
    "topn_per_query",
    _sql(V.HITS_SQL)
    + """, v_ranked AS (SELECT query, seq, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, seq) AS rank FROM v_hits)
    SELECT query, seq, score, CAST(rank AS INTEGER) AS rank FROM v_ranked WHERE rank <= 1000""",
)
def topn_per_query(spark, sf):
    return D.top_per_query(V.hits(spark, sf).select("query", "seq", "score"), "score", "seq")


# --- page log -------------------------------------------------------------------------

_LAST_SQL = """, v_last AS (SELECT * FROM
  (SELECT *, row_number() OVER (PARTITION BY query ORDER BY page DESC) AS rn FROM v_log) WHERE rn = 1)"""


@query(
    "query_frontier",
    _sql(V.PAGE_LOG_SQL)
    + _LAST_SQL
    + """, v_state AS (SELECT *, found > 0 AND CASE WHEN new = 0 THEN page < 5 ELSE page < 10 END AS goes_on FROM v_last)
    SELECT query, page, found, new, CASE WHEN goes_on THEN 'open' ELSE 'done' END AS status,
      CASE WHEN goes_on THEN page + 1 END AS next_page FROM v_state""",
)
def query_frontier(spark, sf):
    return D.query_frontier(page_counts(spark, sf))


@query(
    "short_page_stop",
    _sql(V.PAGE_LOG_SQL)
    + _LAST_SQL
    + """, v_state AS (SELECT *, found >= 100 AND page < 10 AS goes_on FROM v_last)
    SELECT query, page, found, CASE WHEN goes_on THEN 'open' ELSE 'done' END AS status,
      CASE WHEN goes_on THEN page + 1 END AS next_page FROM v_state""",
)
def short_page_stop(spark, sf):
    return D.short_page_stop(page_counts(spark, sf))


@query(
    "pending_queries_by_text",
    _sql(V.PAGE_LOG_SQL)
    + _LAST_SQL
    + """, v_state AS (SELECT *, found > 0 AND CASE WHEN new = 0 THEN page < 5 ELSE page < 10 END AS goes_on FROM v_last)
    SELECT query, p_type, p_size FROM (SELECT DISTINCT p_brand AS query, p_type, p_size FROM part
      UNION ALL SELECT query, 'logged', 0 FROM v_last)
    WHERE query NOT IN (SELECT query FROM v_state WHERE NOT goes_on)""",
)
def pending_queries_by_text(spark, sf):
    """Queries are done by their text alone, whatever sort they were to run with."""
    parts = V.table(spark, sf, "part").select(F.col("p_brand").alias("query"), "p_type", "p_size").distinct()
    frontier = query_frontier(spark, sf)
    logged = frontier.select("query", F.lit("logged").alias("p_type"), F.lit(0).alias("p_size"))
    done = frontier.filter("status = 'done'")
    return D.pending(parts.unionByName(logged), done, "query")


_CRAWLED_SQL = (
    _sql(V.TOPICS_SQL, V.PAGE_LOG_SQL)
    + ", "
    + _crawl_sql(C.STAR_LEVELS[0])
    + """, v_asked AS (SELECT query, row_number() OVER (ORDER BY query) AS number FROM (SELECT DISTINCT query FROM v_crawl)),
    v_brands AS (SELECT query AS brand, row_number() OVER (ORDER BY query) - 1 AS place, count(*) OVER () AS brands
      FROM (SELECT DISTINCT query FROM v_log))"""
)


def _crawl_log(spark: SparkSession, sf: str, queries: DataFrame, threshold: int) -> DataFrame:
    """A page log of generated queries: each has the log of one brand, dealt out in turn."""
    log = page_counts(spark, sf)
    brands = running_sums(log.select(F.col("query").alias("brand")).distinct(), ["brand"], {"place": None})
    count = brands.count()
    asked = running_sums(queries.select("query").distinct(), ["query"], {"number": None})
    dealt = asked.join(brands, F.col("number") % count == F.col("place") - 1).select("query", "brand")
    pages = dealt.join(log.withColumnRenamed("query", "brand"), "brand").drop("brand")
    return pages.withColumn("threshold", F.lit(threshold))


def _generator(spark: SparkSession, sf: str):
    topics = running_sums(state.topics(V.topic_words(spark, sf)), ["topic"], {"position": None})
    return lambda level: D.crawl_queries(topics, current=level)


_STEPPED_SQL = """ SELECT family, c.query, description, sort, "order", {page} AS next_page,
      CAST({level} AS BIGINT) AS current_min_stars, {expanded} AS expanded FROM v_crawl c"""


@query(
    "crawl_step",
    _CRAWLED_SQL
    + """, v_pages AS (SELECT a.query, l.page, l.found, l.new FROM v_asked a JOIN v_brands b ON a.number % b.brands = b.place
        JOIN v_log l ON l.query = b.brand),
      v_last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY page DESC) AS rn FROM v_pages) WHERE rn = 1),
      v_state AS (SELECT *, found > 0 AND CASE WHEN new = 0 THEN page < 5 ELSE page < 10 END AS goes_on FROM v_last)"""
    + ", v_step AS ("
    + _STEPPED_SQL.format(page="CAST(coalesce(s.page + 1, 1) AS BIGINT)", level=C.STAR_LEVELS[0], expanded="false")
    + """ LEFT JOIN v_state s ON s.query = c.query WHERE coalesce(s.goes_on, true) AND c.family <> 'size'),
      v_lower AS (WITH """
    + _crawl_sql(C.STAR_LEVELS[1])
    + _STEPPED_SQL.format(page="CAST(1 AS BIGINT)", level=C.STAR_LEVELS[1], expanded="true")
    + ") SELECT * FROM v_step UNION ALL SELECT * FROM v_lower WHERE NOT EXISTS (SELECT 1 FROM v_step)",
)
def crawl_step(spark, sf):
    """The queries of the highest threshold: as far as they are logged, one family finished otherwise; those
    of the next one if all are done. What is logged for the next threshold does not count."""
    generate, (now, lower) = _generator(spark, sf), C.STAR_LEVELS[:2]
    queries = generate(now)
    log = _crawl_log(spark, sf, queries, now)
    log = log.unionByName(log.withColumn("page", F.col("page") + 1).withColumn("threshold", F.lit(lower)))
    done = queries.filter("family = 'size'").select("query", F.lit(now).alias("threshold"))
    return D.crawl_step(generate, log, done, C.STAR_LEVELS, now)


@query(
    "crawl_step_expanded",
    _sql(V.TOPICS_SQL)
    + ", "
    + _crawl_sql(C.STAR_LEVELS[1])
    + _STEPPED_SQL.format(page="CAST(1 AS BIGINT)", level=C.STAR_LEVELS[1], expanded="true"),
)
def crawl_step_expanded(spark, sf):
    """All queries of the highest threshold are done: those of the next one are generated and start."""
    generate, (now, lower) = _generator(spark, sf), C.STAR_LEVELS[:2]
    done = generate(now).select("query", F.lit(now).alias("threshold"))
    log = _crawl_log(spark, sf, generate(lower), lower)
    return D.crawl_step(generate, log, done, C.STAR_LEVELS, now)


@query(
    "next_threshold",
    _sql(V.PAGE_LOG_SQL, V.REPOS_SQL, _LEVELS_SQL)
    + _LAST_SQL
    + """, v_gate AS (SELECT count(*) FILTER (found > 0 AND CASE WHEN new = 0 THEN page < 5 ELSE page < 10 END) AS open_queries,
        count(*) AS queries FROM v_last),
      v_step AS (SELECT level, lead(level) OVER (ORDER BY level DESC) AS lower FROM v_levels)
    SELECT level AS current, open_queries, queries, lower IS NOT NULL AS can_expand,
      CASE WHEN open_queries = 0 AND lower IS NOT NULL THEN lower ELSE level END AS next_level
    FROM v_step, v_gate WHERE level = (SELECT max(level) FROM v_levels)""",
)
def next_threshold(spark, sf):
    levels = _levels(spark, sf)
    highest = levels.agg(F.max("level")).first()[0]
    return D.next_threshold(levels, query_frontier(spark, sf), highest)


@query(
    "page_map",
    """WITH v_page AS (SELECT event_id, event_type, CAST(1 + floor(event_id / 500.0) AS BIGINT) AS page FROM events)
    SELECT event_id, CASE WHEN event_type = 'click' THEN page ELSE 1 END AS clicks_at, page + 1 AS own_next,
      CAST(0 AS INTEGER) AS left_after_done FROM v_page""",
)
def page_map(spark, sf):
    hit = V.hits(spark, sf).withColumn("pages", F.create_map("query", "page"))
    return hit.select(
        F.col("seq").alias("event_id"),
        D.page_map(F.col("pages"), F.lit("click")).alias("clicks_at"),
        D.page_map(D.page_map_set(F.col("pages"), F.col("query"), F.col("page") + 1), F.col("query")).alias("own_next"),
        F.size(D.page_map_done(F.col("pages"), F.col("query"))).alias("left_after_done"),
    )


# --- budgets and running values -------------------------------------------------------


@query(
    "token_budget",
    _sql(V.REPOS_SQL)
    + """, v_run AS (SELECT repo_id, stars AS tokens, CAST(sum(stars) OVER (ORDER BY repo_id) AS BIGINT) AS running_tokens FROM v_repos)
    SELECT * FROM v_run WHERE running_tokens - tokens < 3000000""",
)
def token_budget(spark, sf):
    repos = V.repos(spark, sf).select("repo_id", F.col("stars").alias("tokens"))
    return D.token_budget(repos, 3_000_000, ["repo_id"])


@query(
    "target_n",
    _sql(V.PAGE_LOG_SQL)
    + """, v_run AS (SELECT query, page, new, CAST(sum(new) OVER (ORDER BY page, query) AS BIGINT) AS running_new FROM v_log)
    SELECT * FROM v_run WHERE running_new - new < 100""",
)
def target_n(spark, sf):
    steps = page_counts(spark, sf).select("query", "page", "new")
    return D.until_target(steps, 100, ["page", "query"])


@query(
    "sliding_rate",
    """WITH v_us AS (SELECT ts, epoch_us(ts) AS us FROM events)
    SELECT DISTINCT us, count(*) OVER (ORDER BY us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS requests FROM v_us""",
)
def sliding_rate(spark, sf):
    rate = D.request_rate(V.table(spark, sf, "events"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return rate.select(F.timestamp_diff("MICROSECOND", epoch, F.col("ts")).alias("us"), "requests")


@query(
    "outcome_counts",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'cloned' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS status, count(*) AS repos
    FROM orders GROUP BY 1""",
)
def outcome_counts(spark, sf):
    status = F.col("o_orderstatus")
    outcome = F.when(status == "F", "cloned").when(status == "O", "skipped").otherwise("failed")
    return D.outcome_counts(V.table(spark, sf, "orders").select(outcome.alias("status")))


@query(
    "session_counts",
    """SELECT count(*) AS all_time_repos, count(*) FILTER (o_orderdate >= DATE '1998-01-01') AS session_repos,
      CAST(sum(o_orderkey) AS BIGINT) AS all_time_tokens,
      CAST(coalesce(sum(o_orderkey) FILTER (o_orderdate >= DATE '1998-01-01'), 0) AS BIGINT) AS session_tokens FROM orders""",
)
def session_counts(spark, sf):
    log = V.table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("cloned_at"), F.col("o_orderkey").alias("tokens")
    )
    return D.session_counts(log, F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))


# --- names, stars, keys ---------------------------------------------------------------

_NAMES_SQL = """v_named AS (
  SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'topics' WHEN 1 THEN 'my-resources' WHEN 2 THEN 'solutions-x'
      WHEN 3 THEN 'sponsors' ELSE lower(p_type) END || '/' || replace(p_name, ' ', CASE WHEN p_size % 5 = 4 THEN '/' ELSE '-' END) AS name,
    CAST(p_size % 7 AS BIGINT) AS stars FROM part)"""


def _names(spark, sf):
    size = F.col("p_size")
    owners = [F.lit(o) for o in ("topics", "my-resources", "solutions-x", "sponsors")] + [F.lower("p_type")] * 2
    owner = F.element_at(F.array(*owners), size % 6 + 1)
    joint = F.when(size % 5 == 4, "/").otherwise("-")
    name = F.concat(owner, F.lit("/"), F.replace("p_name", F.lit(" "), joint))
    return V.table(spark, sf, "part").select("p_partkey", name.alias("name"), (size % 7).cast("long").alias("stars"))


@query(
    "filter_repo_name",
    _sql(_NAMES_SQL)
    + """ SELECT * FROM v_named WHERE len(string_split(name, '/')) = 2 AND stars > 0
      AND NOT regexp_matches(name, 'solutions|resources|topics|sponsors')""",
)
def filter_repo_name(spark, sf):
    name = F.col("name")
    return _names(spark, sf).filter(search.one_slash(name) & (F.col("stars") > 0) & search.not_blocked(name))


@query(
    "filter_star_range",
    _sql(V.REPOS_SQL)
    + """ SELECT full_name, stars, CASE WHEN stars >= 10000 THEN '>=10000' WHEN stars >= 5000 THEN '5000..9999'
      WHEN stars >= 2000 THEN '2000..4999' WHEN stars >= 1000 THEN '1000..1999' WHEN stars >= 500 THEN '500..999'
      WHEN stars >= 200 THEN '200..499' WHEN stars >= 100 THEN '100..199' WHEN stars >= 50 THEN '50..99'
      WHEN stars >= 20 THEN '20..49' WHEN stars >= 10 THEN '10..19' WHEN stars >= 5 THEN '5..9' ELSE '1..4' END AS star_range
    FROM v_repos WHERE stars >= 1""",
)
def filter_star_range(spark, sf):
    stars, ranged = F.col("stars"), F.lit(None).cast("string")
    for text in C.WEB_STAR_RANGES:
        ranged = F.when(search.in_star_range(stars, text), text).otherwise(ranged)
    labelled = V.repos(spark, sf).select("full_name", "stars", ranged.alias("star_range"))
    return labelled.filter("star_range IS NOT NULL")


@query(
    "parse_stars",
    """WITH v_text AS (SELECT p_partkey, p_size, CASE p_size % 5
      WHEN 0 THEN 'aria-label="' || p_partkey || ' stars"'
      WHEN 1 THEN 'aria-label="1,' || p_partkey || ' stars" href="/a/b/stargazers"><i></i><span>' || (p_size / 10.0::DOUBLE) || 'k</span>'
      WHEN 2 THEN 'href="/a/b/stargazers" x><span class="n">' || p_size || 'M</span>'
      WHEN 3 THEN 'aria-label="0 stars" href="/a/b/stargazers">' || chr(10) || '<span>' || p_partkey || '</span>'
      ELSE 'no stars' END AS context FROM part)
    SELECT p_partkey, CAST(CASE p_size % 5 WHEN 0 THEN p_partkey WHEN 1 THEN trunc(p_size / 10.0::DOUBLE * 1000.0::DOUBLE)
      WHEN 2 THEN p_size * 1000000 WHEN 3 THEN p_partkey ELSE 0 END AS BIGINT) AS stars FROM v_text""",
)
def parse_stars(spark, sf):
    part, size = F.col("p_partkey").cast("string"), F.col("p_size")
    shapes = [
        F.concat(F.lit('aria-label="'), part, F.lit(' stars"')),
        F.concat(
            F.lit('aria-label="1,'), part, F.lit(' stars" href="/a/b/stargazers"><i></i><span>'),
            (size / 10.0).cast("string"), F.lit("k</span>"),
        ),
        F.concat(F.lit('href="/a/b/stargazers" x><span class="n">'), size.cast("string"), F.lit("M</span>")),
        F.concat(F.lit('aria-label="0 stars" href="/a/b/stargazers">\n<span>'), part, F.lit("</span>")),
        F.lit("no stars"),
    ]
    context = F.element_at(F.array(*shapes), (size % 5 + 1).cast("int"))
    return V.table(spark, sf, "part").select("p_partkey", H.parse_stars(context).alias("stars"))


_QUERY_SQL = """v_queries AS (SELECT event_id, 'language:python "' || event_type || '" in:readme stars:' || user_id || '..' || (user_id + 9) AS query,
  CAST(1 + floor(event_id / 500.0) AS BIGINT) AS page FROM events)"""


def _queries(spark, sf):
    stars = F.concat(F.col("repo_id").cast("string"), F.lit(".."), (F.col("repo_id") + 9).cast("string"))
    text = search.fill(C.API_TEMPLATES[1], topic=F.col("query"), stars=stars)
    return V.hits(spark, sf).select(F.col("seq").alias("event_id"), text.alias("query"), "page")


@query(
    "query_keys",
    _sql(_QUERY_SQL)
    + """ SELECT event_id, query, query || '|forks' AS query_key, query || '|forks|desc|page' || page AS page_key FROM v_queries""",
)
def query_keys(spark, sf):
    q, sort = F.col("query"), F.lit("forks")
    return _queries(spark, sf).select(
        "event_id",
        "query",
        search.query_key(q, sort).alias("query_key"),
        search.page_key(q, sort, F.lit("desc"), F.col("page")).alias("page_key"),
    )


@query(
    "url_build",
    _sql(_QUERY_SQL)
    + """ SELECT event_id, 'https://github.com/search?q=' || replace(query, ' ', '+') || '&type=repositories&s=stars&o=desc&p=' || page AS url,
      'https://github.com/a/' || event_id || '.git' AS clone_url FROM v_queries""",
)
def url_build(spark, sf):
    return _queries(spark, sf).select(
        "event_id",
        search.search_url(F.col("query"), F.lit("stars"), F.col("page")).alias("url"),
        search.clone_url(F.concat(F.lit("a/"), F.col("event_id").cast("string"))).alias("clone_url"),
    )


# --- landed pages ---------------------------------------------------------------------


@query("html_records", _sql(V.SEARCH_SQL) + " SELECT page_id, position, name, stars FROM v_records")
def html_records(spark, sf):
    return state.html_records(V.search_pages(spark, sf))


@query(
    "match_context",
    _sql(V.SEARCH_SQL) + ' SELECT page_id, position, start, "end", md5(context) AS context FROM v_records',
)
def match_context(spark, sf):
    pages = H.with_matches(V.search_pages(spark, sf))
    around = F.transform(
        "matches",
        lambda m: F.struct(
            m["position"].alias("position"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.md5(H.context_of(F.col("html"), m).cast("binary")).alias("context"),
        ),
    )
    return pages.select("page_id", F.inline_outer(around)).filter("position IS NOT NULL")


@query(
    "page_top10",
    _sql(V.SEARCH_SQL)
    + """, v_good AS (SELECT * FROM v_records WHERE stars > 0 AND len(string_split(name, '/')) = 2
        AND NOT regexp_matches(name, 'solutions|resources|topics|sponsors')),
      v_once AS (SELECT *, row_number() OVER (PARTITION BY page_id, name ORDER BY position) AS nth FROM v_good),
      v_top AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY position) - 1 AS rank FROM v_once WHERE nth = 1)
    SELECT page_id, CAST(rank AS INTEGER) AS rank, name AS full_name, 'https://github.com/' || name || '.git' AS clone_url, stars
    FROM v_top WHERE rank < 10""",
)
def page_top10(spark, sf):
    return state.page_hits(V.search_pages(spark, sf))


# --- state ----------------------------------------------------------------------------


@query(
    "seen_read",
    _sql(V.REPOS_SQL) + " SELECT full_name FROM v_repos UNION SELECT full_name || '-fork' FROM v_repos",
)
def seen_read(spark, sf):
    path = staging.new_path(spark, "seen")
    name = F.col("full_name")
    V.repos(spark, sf).select(F.to_json(F.array(name, F.concat(name, F.lit("-fork")))).alias("value")).write.text(path)
    return state.read_names(spark, path, "full_name")


@query(
    "state_defaults",
    _sql(V.REPOS_SQL)
    + """ SELECT full_name AS start_time, CASE WHEN stars % 2 = 0 THEN stars ELSE 0 END AS total_tokens,
      repo_id AS repos_cloned, CASE WHEN stars % 3 = 0 THEN stars ELSE 5000 END AS current_min_stars,
      CAST(0 AS BIGINT) AS threshold_expansions, CAST(CASE WHEN stars % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS completed FROM v_repos""",
)
def state_defaults(spark, sf):
    """Documents that lack some fields, as older versions wrote them."""
    stars = F.col("stars")
    document = F.struct(
        F.col("full_name").alias("start_time"),
        F.when(stars % 2 == 0, stars).alias("total_tokens"),
        F.col("repo_id").alias("repos_cloned"),
        F.when(stars % 3 == 0, stars).alias("current_min_stars"),
        F.when(stars % 2 == 0, F.array("full_name")).alias("search_queries_completed"),
    )
    path = staging.new_path(spark, "progress")
    V.repos(spark, sf).select(F.to_json(document).alias("value")).write.text(path)
    defaults = {
        "total_tokens": F.lit(0),
        "current_min_stars": F.lit(5000),
        "threshold_expansions": F.lit(0),
        "search_queries_completed": F.array().cast("array<string>"),
    }
    return state.read_state(spark, path, PROGRESS, defaults).select(
        "start_time",
        "total_tokens",
        "repos_cloned",
        "current_min_stars",
        "threshold_expansions",
        F.size("search_queries_completed").alias("completed"),
    )


@query(
    "raw_hits",
    """SELECT event_type AS query, 'stars' AS sort, CAST(event_id AS INTEGER) AS page, CAST(2 AS BIGINT) AS total_count,
      CAST(p AS INTEGER) AS position, CAST(user_id + p AS VARCHAR) AS repo_id, event_type || '/' || (user_id + p) AS full_name,
      'u' AS clone_url, CASE p WHEN 0 THEN event_id ELSE 0 END AS stars, CAST(0 AS BIGINT) AS forks, event_id AS size
    FROM events, range(2) r(p)""",
)
def raw_hits(spark, sf):
    """Two items per landed page; the second lacks its star count."""
    item = [
        F.struct(
            (F.col("user_id") + p).alias("id"),
            F.concat("event_type", F.lit("/"), (F.col("user_id") + p).cast("string")).alias("full_name"),
            F.lit("u").alias("clone_url"),
            (F.col("event_id") if p == 0 else F.lit(None).cast("long")).alias("stargazers_count"),
            F.col("event_id").alias("size"),
        )
        for p in (0, 1)
    ]
    document = F.struct(
        F.col("event_type").alias("query"),
        F.lit("stars").alias("sort"),
        F.col("event_id").alias("page"),
        F.lit(2).alias("total_count"),
        F.array(*item).alias("items"),
    )
    path = staging.new_path(spark, "api-pages")
    V.table(spark, sf, "events").select(F.to_json(document).alias("value")).write.text(path)
    return state.read_raw_hits(spark, path)
