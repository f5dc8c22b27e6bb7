"""Search grids, first-seen hits, page logs and what to do next."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill import constants as C
from corpusmill.functions.search import fill, query_key
from corpusmill.operators.ordering import running_sums

# --- query grids ----------------------------------------------------------------------

#: Parts of a query that are ranked on their own.
SALTS = 32


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def query_grid(topics: DataFrame, sorts: list[str], star_ranges: list[str], templates: list[str]) -> DataFrame:
    """Every topic × sort × star range × template: ``topic, sort, stars, query, query_key``.

    The three short lists are exploded within the row of the topic, so the product needs no
    join and no shuffle.
    """
    grid = (
        topics.select("topic")
        .withColumn("sort", F.explode(_array(sorts)))
        .withColumn("stars", F.explode(_array(star_ranges)))
        .withColumn("template", F.explode(_array(templates)))
    )
    return grid.withColumn("query", fill(F.col("template"), stars=F.col("stars"), topic=F.col("topic"))).select(
        "topic", "sort", "stars", "query", query_key(F.col("query"), F.col("sort")).alias("query_key")
    )


def api_queries(topics: DataFrame) -> DataFrame:
    """42 queries per topic for the search API."""
    return query_grid(topics, C.SORTS, C.API_STAR_RANGES, C.API_TEMPLATES)


def web_queries(topics: DataFrame) -> DataFrame:
    """108 queries per topic for the search web pages."""
    return query_grid(topics, C.SORTS, C.WEB_STAR_RANGES, C.WEB_TEMPLATES)


def star_ranges(levels: DataFrame, current: int | None = None) -> DataFrame:
    """Exclusive star ranges from descending thresholds: the top one is open, each other one
    ends below the one before. Ranges start at ``current``, or at the top if it is no level.

    ``levels`` holds distinct ``level`` values. Columns: ``level, upper, tier, stars``.
    """
    above = Window.orderBy(F.desc("level"))  # thresholds are a short dimension
    ranged = levels.select("level", (F.lag("level").over(above) - 1).alias("upper"))
    if current is not None:
        known = F.bool_or(F.col("level") == current).over(Window.partitionBy())
        ranged = ranged.withColumn("_known", known).filter(~F.col("_known") | (F.col("level") <= current))
        ranged = ranged.drop("_known")
    level, upper = F.col("level").cast("string"), F.col("upper").cast("string")
    return ranged.withColumn("tier", F.row_number().over(above)).withColumn(
        "stars",
        F.when(F.col("upper").isNull(), F.concat(F.lit(">="), level)).otherwise(
            F.concat(level, F.lit(".."), upper)
        ),
    )


def exclusive_ranges(levels: list[int], current: int | None = None) -> list[tuple[str, str]]:
    """Query text and label of every exclusive range, for thresholds known up front."""
    start = levels.index(current) if current in levels else 0
    above = [None, *levels[:-1]]
    return [
        (f">={low}", f"{low}+") if high is None else (f"{low}..{high - 1}", f"{low}-{high - 1}")
        for low, high in list(zip(levels, above))[start:]
    ]


def crawl_queries(
    topics: DataFrame,
    *,
    levels: list[int] = C.STAR_LEVELS,
    current: int | None = None,
    words: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Nine families of crawl queries: ``family, query, description, sort, order``.

    ``topics`` holds ``topic, position`` (position from 1); ``levels`` and ``current`` choose the
    star ranges; ``words`` replaces the fixed short lists by name. The lists are exploded within
    a row, so the products need no join.
    """
    lists = {
        "broad": C.CRAWL_BROAD_TOPICS,
        "core": C.CRAWL_CORE_TOPICS,
        "year": C.CRAWL_YEARS,
        "readme": C.CRAWL_README_WORDS,
        "license": C.CRAWL_LICENSES,
        "size": C.CRAWL_SIZES,
        "filename": C.CRAWL_FILENAMES,
    } | (words or {})
    one = topics.sparkSession.range(1).drop("id")
    ranges = exclusive_ranges(levels, current)

    def pairs(values: list[tuple[str, str]], first: str, second: str) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(a).alias(first), F.lit(b).alias(second)) for a, b in values]))

    def listed(name: str, column: str, rows: DataFrame = one) -> DataFrame:
        return rows.select("*", F.explode(_array(lists[name])).alias(column))

    def ranged(rows: DataFrame, tiers: int) -> DataFrame:
        return rows.select("*", pairs(ranges[:tiers], "stars", "label"))

    def sorted_by(rows: DataFrame, sorts: list[tuple[str, str]] = C.CRAWL_SORT_LABELS) -> DataFrame:
        return rows.select("*", pairs(sorts, "sort", "sort_label"))

    def family(name: str, rows: DataFrame, sort: str | None = None) -> DataFrame:
        def filled(template: str) -> Column:
            return fill(template, **{c: F.col(c) for c in rows.columns if "{" + c + "}" in template})

        query, description = C.CRAWL_TEMPLATES[name]
        return rows.select(
            F.lit(name).alias("family"),
            filled(query).alias("query"),
            filled(description).alias("description"),
            (F.col("sort") if sort is None else F.lit(sort)).alias("sort"),
            F.lit("desc").alias("order"),
        )

    dated = topics.filter(F.col("position") <= C.CRAWL_RECENT_TOPICS).withColumn("date", F.lit(C.CRAWL_RECENT_DATE))
    families = [
        family("topic", sorted_by(ranged(topics, 3))),
        family("recent", ranged(dated, 2), "updated"),
        family("broad", sorted_by(ranged(listed("broad", "topic"), 3))),
        family("year", ranged(listed("core", "topic", listed("year", "year")), 2), "stars"),
        family("readme", ranged(listed("readme", "word"), 2), "stars"),
        family("license", ranged(listed("license", "license"), 2), "stars"),
        family("size", sorted_by(listed("size", "size"), C.CRAWL_SORT_LABELS[:2])),
        family("filename", ranged(listed("filename", "filename"), 2), "stars"),
        family("archived", ranged(one.select(pairs(C.CRAWL_ARCHIVED, "topic", "short")), 2), "stars"),
    ]
    return reduce(DataFrame.unionByName, families)


def fixed_topics(spark: SparkSession) -> DataFrame:
    """The fixed crawl topics with their positions."""
    return spark.range(1).select(F.posexplode(_array(C.CRAWL_TOPICS)).alias("p", "topic")).select(
        "topic", (F.col("p") + 1).alias("position")
    )


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not in ``done``: queries not run, repositories not processed."""
    return rows.join(done.select(key), key, "left_anti").select(*rows.columns)


# --- hits -----------------------------------------------------------------------------


def first_seen(hits: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """First hit of every ``key``. An aggregate, so a key with very many hits is reduced on the
    map side before the shuffle."""
    whole = F.struct(*hits.columns)
    return hits.groupBy(key).agg(F.min_by(whole, F.struct(*order_by)).alias("_first")).select("_first.*")


def new_hits(hits: DataFrame, seen: DataFrame, cloned: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """First hits of keys that are neither seen nor cloned before."""
    return pending(pending(first_seen(hits, key, order_by), seen, key), cloned, key)


def merge_hits(existing: DataFrame, new: DataFrame, key: str = "full_name") -> DataFrame:
    """Append rows with new keys; existing rows are never changed."""
    return existing.unionByName(pending(new, existing, key))


def page_counts(hits: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Per query and page: hits found, new ones among them, and the rest."""
    found = hits.groupBy("query", "page").agg(F.count(F.lit(1)).alias("found"))
    slim = hits.select(*dict.fromkeys(["query", "page", key, *order_by]))
    new = first_seen(slim, key, order_by).groupBy("query", "page").agg(F.count(F.lit(1)).alias("new"))
    return found.join(new, ["query", "page"], "left").select(
        "query",
        "page",
        "found",
        F.coalesce("new", F.lit(0)).alias("new"),
        (F.col("found") - F.coalesce("new", F.lit(0))).alias("skipped"),
    )


def query_repo_edges(results: DataFrame, repos: DataFrame) -> DataFrame:
    """Which query found which repository: one row per id of a result page."""
    edges = results.select("query", "page", F.posexplode("repo_ids").alias("position", "repo_id"))
    return edges.join(repos.select("repo_id", "full_name"), "repo_id").select(
        "query", "page", "position", "repo_id", "full_name"
    )


def top_per_query(hits: DataFrame, metric: str, tie: str, limit: int = C.MAX_PAGES * C.PAGE_SIZE) -> DataFrame:
    """Best ``limit`` hits of each query, ranked first within ``SALTS`` parts of a query, then among
    what these leave, so that a query with very many hits is cut down by many tasks. Spark cuts each
    map partition before either shuffle, as long as
    ``spark.sql.optimizer.windowGroupLimitThreshold`` allows."""
    order = [F.desc(metric), F.asc(tie)]
    parted = Window.partitionBy("query", "_part").orderBy(*order)
    part = F.pmod(F.xxhash64(tie), F.lit(SALTS))
    survivors = hits.withColumn("_part", part).withColumn("_rank", F.row_number().over(parted))
    survivors = survivors.filter(F.col("_rank") <= limit).drop("_part", "_rank")
    ranked = Window.partitionBy("query").orderBy(*order)
    return survivors.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= limit)


# --- page log -------------------------------------------------------------------------


def _last_page(log: DataFrame) -> DataFrame:
    latest = F.max_by(F.struct("page", "found", "new"), "page").alias("last")
    return log.groupBy("query").agg(latest).select("query", "last.*")


def query_frontier(log: DataFrame) -> DataFrame:
    """State of every query after its last page: ``query, status, next_page``.

    A page without results ends a query. A page without new results is followed by another up
    to page 5. A page with new results is followed by another up to page 10.
    """
    last = _last_page(log)
    goes_on = (F.col("found") > 0) & F.when(
        F.col("new") == 0, F.col("page") < C.EMPTY_PAGE_RETRIES
    ).otherwise(F.col("page") < C.MAX_PAGES)
    return last.select(
        "query",
        "page",
        "found",
        "new",
        F.when(goes_on, "open").otherwise("done").alias("status"),
        F.when(goes_on, F.col("page") + 1).cast("long").alias("next_page"),
    )


def short_page_stop(log: DataFrame, page_size: int = C.PAGE_SIZE) -> DataFrame:
    """Variant in which a page that is not full, or page 10, ends the query."""
    goes_on = (F.col("found") >= page_size) & (F.col("page") < C.MAX_PAGES)
    return _last_page(log).select(
        "query",
        "page",
        "found",
        F.when(goes_on, "open").otherwise("done").alias("status"),
        F.when(goes_on, F.col("page") + 1).cast("long").alias("next_page"),
    )


def page_map(stored: Column, query: Column) -> Column:
    """Page a query continues at; 1 if none is stored."""
    return F.coalesce(F.try_element_at(stored, query), F.lit(1).cast("long"))


def page_map_set(stored: Column, query: Column, page: Column) -> Column:
    """Map with the page of ``query`` set."""
    others = F.map_filter(stored, lambda k, _: k != query)
    return F.map_concat(others, F.create_map(query, page))


def page_map_done(stored: Column, query: Column) -> Column:
    """Map without ``query``, which is finished."""
    return F.map_filter(stored, lambda k, _: k != query)


def next_threshold(levels: DataFrame, states: DataFrame, current: int) -> DataFrame:
    """Threshold to go on with, as one row: the next lower one once every query is done, if there
    is one. ``states`` holds ``status`` per query."""
    level = F.col("level")
    step = levels.agg(
        F.bool_or(level == current).alias("known"), F.max(F.when(level < current, level)).alias("lower")
    )
    gate = states.agg(
        F.count_if(F.col("status") != "done").alias("open_queries"), F.count(F.lit(1)).alias("queries")
    )
    row = step.unionByName(gate, allowMissingColumns=True)
    whole = row.agg(*[F.max(c).alias(c) for c in row.columns])
    can = F.coalesce("known", F.lit(False)) & F.col("lower").isNotNull()
    now = F.lit(current).cast("long")
    return whole.select(
        now.alias("current"),
        "open_queries",
        "queries",
        can.alias("can_expand"),
        F.when(can & (F.col("open_queries") == 0), F.col("lower")).otherwise(now).alias("next_level"),
    )


def crawl_step(
    generate: Callable[[int], DataFrame], log: DataFrame, done: DataFrame, levels: list[int], current: int
) -> DataFrame:
    """What to run next: the columns of ``generate`` and ``next_page, current_min_stars, expanded``.

    ``generate`` gives the queries of a threshold (:func:`crawl_queries`), ``levels`` holds the
    thresholds from the highest down. ``log`` (pages with the ``threshold`` they were run for) and
    ``done`` (``query, threshold``, finished otherwise) count for their own threshold only, so an
    expansion empties the done set and the page map without a change to either. A query goes on at the
    page its log asks for, one without a log at page 1. Once all queries of the current threshold are
    done and there is a lower one, the queries of that threshold start at page 1, ``expanded`` is true,
    and the caller goes on with ``current_min_stars``.
    """
    frontier = query_frontier(log.filter(F.col("threshold") == current).drop("threshold"))
    finished = done.filter(F.col("threshold") == current).select("query")
    finished = finished.unionByName(frontier.filter("status = 'done'").select("query")).distinct()
    asked = generate(current)
    marked = asked.join(finished.withColumn("_done", F.lit(True)), "query", "left")
    pages = frontier.select("query", F.col("next_page").alias("_page"))
    todo = marked.filter(F.col("_done").isNull()).join(pages, "query", "left")

    def step(rows: DataFrame, page: Column, level: int) -> DataFrame:
        return rows.select(
            *asked.columns,
            page.cast("long").alias("next_page"),
            F.lit(level).cast("long").alias("current_min_stars"),
            F.lit(level != current).alias("expanded"),
        )

    going_on = step(todo, F.coalesce("_page", F.lit(1)), current)
    if current not in levels[:-1]:
        return going_on
    lower = levels[levels.index(current) + 1]
    gate = marked.agg(F.count_if(F.col("_done").isNull()).alias("_open"))  # one row
    fresh = generate(lower).join(F.broadcast(gate)).filter("_open = 0")
    return going_on.unionByName(step(fresh, F.lit(1), lower))


# --- budgets and running values -------------------------------------------------------


def token_budget(repos: DataFrame, target: int, order_by: list[str]) -> DataFrame:
    """Repositories in order until their tokens reach ``target``, the crossing one included."""
    summed = running_sums(repos, order_by, {"running_tokens": "tokens"})
    return summed.filter(F.col("running_tokens") - F.col("tokens") < target)


def until_target(steps: DataFrame, target: int, order_by: list[str]) -> DataFrame:
    """Steps (pages, or queries) taken until ``target`` new rows; checked between steps, so the
    last one may overshoot. Wants ``new``."""
    summed = running_sums(steps, order_by, {"running_new": "new"})
    return summed.filter(F.col("running_new") - F.col("new") < target)


def request_rate(times: DataFrame, column: str = "ts", seconds: int = C.RATE_WINDOW_SECONDS) -> DataFrame:
    """For every distinct time: requests in the window that ends there, its start excluded.

    Each request adds one at its time and takes it back when it leaves the window, so the count
    is a running sum over both kinds of change. Requests of one time are added up first.
    """
    step = F.make_dt_interval(secs=F.lit(seconds))
    arrive = times.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    changes = arrive.select(column, "n", F.lit(True).alias("arrives")).unionByName(
        arrive.select((F.col(column) + step).alias(column), (-F.col("n")).alias("n"), F.lit(False).alias("arrives"))
    )
    summed = running_sums(changes, [column, "arrives"], {"requests": "n"})
    return summed.filter("arrives").select(column, "requests")


def outcome_counts(log: DataFrame, column: str = "status") -> DataFrame:
    """How often each outcome occurs."""
    return log.groupBy(column).agg(F.count(F.lit(1)).alias("repos"))


def session_counts(repos: DataFrame, session_start: Column) -> DataFrame:
    """Repositories and tokens of this session and of all time."""
    now = F.col("cloned_at") >= session_start
    return repos.agg(
        F.count(F.lit(1)).alias("all_time_repos"),
        F.count_if(now).alias("session_repos"),
        F.sum("tokens").alias("all_time_tokens"),
        F.sum(F.when(now, F.col("tokens")).otherwise(0)).alias("session_tokens"),
    )
