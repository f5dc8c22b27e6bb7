"""Near copies: texts whose sets of five-word shingles agree (Jaccard) to ``SIMILARITY`` or more.

Candidates share a band, which is ``ROWS`` smallest values of permuted shingle hashes; a pair that
agrees to j shares none of ``BANDS`` bands with probability (1 - j ** ROWS) ** BANDS, 5e-5 at 0.8. A search by
fingerprint (``simhash``) gives further candidates: each group it finds counts as one more band.
Every candidate pair is then decided by its exact similarity, and a component is all that links
reach. Texts with equal sets become one first.

A band is not compared pair by pair. Each member is first compared with the smallest of its band, the
smallest such one first, and with others only if that leaves them in different components. Bands
whose other members are then still in different components are taken together in clusters, by the
members they share, and a cluster is searched around its centre, the shingles that more than half of
its members hold. What two sets do not share is what their differences from the centre do not share, so
(1) two members that are close to it are alike, and all such pairs are joined by a star; (2) any other
alike pair shares a known part of these differences, which a prefix filter finds: what a copy has of its
own comes first, so copies of one text do not all meet. What meets is decided by its exact similarity.

Defined results: words and shingles as in ``shingles``; null, empty and wordless texts have the
empty set and are copies of each other; texts of any length are read whole; rows with one id are one
node; rows with a null id are left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import staging
from corpusmill.llm import common, components, sieve, skew
from corpusmill.llm.shingles import fingerprint, shingle_hashes, words_of

SHINGLE = 5
#: Similarity is at least 4 of 5: what two sets do not share is at most a ninth of their sizes.
SIMILARITY = 0.8
EASY, HARD = 1, 9
BANDS = 25
ROWS = 5
#: Shingles whose permuted hashes are in memory together.
PART = 1 << 12
#: Words of a shingle of the fingerprint.
FINGERPRINT_SHINGLE = 3
FIELDS = common.struct(key=T.BinaryType(), size=common.LONG, bands=T.ArrayType(common.LONG), fingerprint=common.LONG)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """What to flip in a hash and, odd, what to multiply it by, for each value of each band."""
    drawn = np.random.default_rng(5).integers(0, 1 << 32, (2, BANDS * ROWS, 1), np.uint32)
    return drawn[0], drawn[1] | np.uint32(1)


def shingles_of(text: str) -> np.ndarray:
    """The set of shingles, as sorted hashes."""
    return np.unique(shingle_hashes(words_of(text), SHINGLE))


def bands_of(hashes: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> list[int]:
    """Hashes of the bands, each with its number; none for the empty set."""
    if not len(hashes):
        return []
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(flips), 0xFFFFFFFF, np.uint32)
    for low in range(0, len(short), PART):
        np.minimum(least, ((short[low : low + PART] ^ flips) * factors).min(axis=1), out=least)
    return [xxhash.xxh3_64_intdigest(row.tobytes(), i) for i, row in enumerate(least.reshape(BANDS, ROWS))]


def sketches(df: DataFrame) -> DataFrame:
    """``id, key, size, bands, fingerprint`` of rows ``id, text``; the key stands for the set."""

    def start():
        flips, factors = permutations()

        def compute(texts: list[str]) -> dict[str, pa.Array]:
            sets = [shingles_of(t) for t in texts]
            bands = [np.array(bands_of(s, flips, factors), np.uint64).view(np.int64) for s in sets]
            prints = [fingerprint(shingle_hashes(words_of(t), FINGERPRINT_SHINGLE)) for t in texts]
            return {
                "key": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                "size": pa.array([len(s) for s in sets], pa.int64()),
                "bands": pa.array(bands, pa.list_(pa.int64())),
                "fingerprint": pa.array(prints, pa.int64()),
            }

        return compute

    return common.annotate(df, start, FIELDS, "text", ["id"]).select("row.id", "result.*")


def sets_of(df: DataFrame) -> DataFrame:
    """``id, hashes`` of rows ``id, text``."""

    def start():
        def compute(texts: list[str]) -> dict[str, pa.Array]:
            return {"hashes": pa.array([shingles_of(t).view(np.int64) for t in texts], pa.list_(pa.int64()))}

        return compute

    fields = common.struct(hashes=T.ArrayType(common.LONG))
    return common.annotate(df, start, fields, "text", ["id"]).select("row.id", "result.hashes")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The staged ``pairs`` ``a, b`` whose sets are alike, staged."""
    dealt, parts = skew.deal(pairs, "a", "b")
    own = dealt.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("own")), "b")
    its = parts.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("its")), "a")
    both = own.join(its, ["a", "part"])
    size, shared = F.size("its") + F.size("own"), F.size(F.array_intersect("its", "own"))
    return staging.stage(both.where(HARD * (size - 2 * shared) <= EASY * size).select("a", "b"), "near-copies-links")


def sizes_fit(a: str, b: str):
    """Sets of such sizes can be alike."""
    return (HARD + EASY) * F.least(a, b) >= (HARD - EASY) * F.greatest(a, b)


def rooted(rows: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    """``rows`` with the component of ``node``, named itself where ``roots`` do not have it."""
    known = roots.select(F.col("node").alias(node), F.col("root").alias("__root"))
    return rows.join(known, node, "left").withColumn(root, F.coalesce("__root", node)).drop("__root")


def parted(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``a, b`` of pairs in different components."""
    return rooted(rooted(pairs, roots, "a", "__a"), roots, "b", "__b").where("__a != __b").select("a", "b")


def centred(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Staged ``members`` (``cluster, node, size``) with ``apart``, what their set does not share with
    the centre of their cluster: shingles of one but not both."""
    held = staging.stage(members.join(sets.withColumnRenamed("id", "node"), "node"), "near-copies-held")
    sizes = held.groupBy("cluster").agg(F.count("*").alias("n"))
    counts = held.select("cluster", F.explode("hashes").alias("h")).groupBy("cluster", "h").agg(F.count("*").alias("held"))
    most = counts.join(sizes, "cluster").where("2 * held > n").groupBy("cluster").agg(F.collect_list("h").alias("centre"))
    every = sizes.join(most, "cluster", "left").select("cluster", F.coalesce("centre", F.array().cast("array<bigint>")).alias("centre"))
    dealt, parts = skew.deal(held, "cluster", "node")
    met = dealt.join(parts.join(every, "cluster"), ["cluster", "part"])
    apart = F.concat(F.array_except("hashes", "centre"), F.array_except("centre", "hashes"))
    return staging.stage(met.select("cluster", "node", "size", apart.alias("apart")), "near-copies-apart")


def around(apart: DataFrame) -> DataFrame:
    """Edges ``a, b`` of pairs that are alike by their distance from the centre alone, in a star: the
    member with the most to spare is alike with every member that is so alike with any."""
    spare = F.lit(EASY) * F.col("size") - F.lit(HARD) * F.size("apart")
    hubs = apart.groupBy("cluster").agg(F.max(F.struct(spare.alias("spare"), F.col("node").alias("hub"))).alias("hub"))
    hubs = hubs.join(apart.groupBy("cluster").agg(F.count("*").alias("n")), "cluster")
    hubs = staging.stage(hubs.select("cluster", "n", "hub.hub", F.col("hub.spare").alias("most")), "near-copies-hubs")
    total = hubs.agg(F.sum("n")).first()[0] or 0
    met = skew.attach(apart.select("cluster", "node", spare.alias("spare")), hubs, "cluster", total, "inner")
    return met.where("node != hub AND spare + most >= 0").select(F.col("hub").alias("a"), F.col("node").alias("b"))


def meeting(apart: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of a cluster in different components that may be alike: they share enough of what
    parts them from the centre. A prefix filter: with the rarest first, what two alike sets share begins
    early in both."""
    one = apart.select("cluster", "node", "size", F.size("apart").alias("d"), F.explode("apart").alias("h"))
    one = staging.stage(one.withColumn("key", F.struct("cluster", "h")), "near-copies-single")
    facts = staging.stage(one.groupBy("key").agg(F.count("*").alias("n"), F.count("*").alias("often")), "near-copies-often")
    total = facts.agg(F.sum("n")).first()[0] or 0
    ranked = skew.attach(one, facts, "key", total, "inner").where("often > 1")
    # places count from the rarest on; what occurs once is shared with none, but takes its places
    shared = ranked.groupBy("cluster", "node", "size", "d").agg(F.sort_array(F.collect_list(F.struct("often", "h"))).alias("rest"))
    placed = shared.select("*", F.posexplode("rest").alias("at", "one")).select(
        "cluster", "node", "size", "d", F.col("one.h").alias("h"), (F.col("d") - F.size("rest") + F.col("at")).alias("at")
    )
    # the partner has a size of (HARD + EASY) / (HARD - EASY) times this one at most
    early = placed.where((HARD - EASY) * HARD * F.col("at") <= 2 * HARD * EASY * F.col("size"))
    early = staging.stage(rooted(early, roots, "node", "root"), "near-copies-early")
    x, y = (early.select(*(F.col(c).alias(f"{p}{c}") for c in early.columns)) for p in ("x", "y"))
    need = HARD * (F.col("xd") + F.col("yd")) - EASY * (F.col("xsize") + F.col("ysize"))  # in units of 2 * HARD
    left = 2 * HARD * F.least(F.col("xd") - F.col("xat"), F.col("yd") - F.col("yat"))
    same = (F.col("xcluster") == F.col("ycluster")) & (F.col("xh") == F.col("yh"))
    fits = (F.col("xnode") < F.col("ynode")) & (F.col("xroot") != F.col("yroot")) & (need > 0) & (left >= need)
    return x.join(y, same & fits & sizes_fit("xsize", "ysize")).select(F.col("xnode").alias("a"), F.col("ynode").alias("b")).distinct()


def searched(prints: DataFrame, nodes: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``node, size, band`` of the groups that ``search`` finds by the fingerprints of ``prints``. Texts of
    one set may have several fingerprints; the empty set is like no other and has no group."""
    every = prints.where("size > 0").select("key", "fingerprint").distinct()
    every = every.join(nodes.select("key", F.col("node").alias("id"), "size"), "key")
    every = every.select("id", "size", "fingerprint", F.array().cast("array<bigint>").alias("proofs"))
    found = search(staging.stage(every, "near-copies-fingerprints"))
    band = F.xxhash64(F.lit("fingerprint"), "component")
    return found.select(F.col("id").alias("node"), "size", band.alias("band")).distinct()


def links(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """Edges ``a, b`` that join all nodes of the staged ``keyed`` (``node, size, band``) that share a band
    and are alike by the texts of ``rows`` (``id, text``)."""
    first = F.min(F.struct("node", "size"))
    grouped = keyed.groupBy("band").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    facts = staging.stage(grouped, "near-copies-groups")
    total = facts.agg(F.sum("n")).first()[0] or 0
    members = staging.stage(
        skew.attach(keyed, facts, "band", total, "inner").select("band", "node", "size", "first"), "near-copies-members"
    )
    wanted = staging.stage(members.select(F.col("node").alias("id")).distinct(), "near-copies-wanted")
    sets = staging.stage(sets_of(sieve.among(rows, wanted, "id")), "near-copies-sets")

    fitting = members.where((F.col("node") != F.col("first.node")) & sizes_fit("size", "first.size"))
    tried = staging.stage(fitting.select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct(), "near-copies-pairs")
    smallest = tried.groupBy("b").agg(F.min("a").alias("a"))
    found = linked(staging.stage(smallest, "near-copies-smallest"), sets)
    roots = staging.stage(components.connected(found), "near-copies-roots")
    others = staging.stage(parted(tried.join(smallest, ["a", "b"], "left_anti"), roots), "near-copies-others")
    found = found.unionByName(linked(others, sets))
    roots = staging.stage(components.connected(found), "near-copies-roots")

    placed = rooted(members.withColumn("lead", F.col("first.node")).drop("first"), roots, "node", "root")
    placed = staging.stage(placed, "near-copies-placed")
    rest = placed.where("node != lead").groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    still = staging.stage(rest.where("low != high").select("band").join(facts.select("band", "n"), "band"), "near-copies-open")
    open_ = staging.stage(skew.attach(placed, still, "band", total, "inner"), "near-copies-strays")
    clusters = components.connected(open_.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct())
    clustered = rooted(open_.select("node", "size").distinct(), clusters, "node", "cluster")
    apart = centred(staging.stage(clustered, "near-copies-clustered"), sets)
    found = found.unionByName(staging.stage(around(apart), "near-copies-around"))
    roots = staging.stage(components.connected(found), "near-copies-roots")
    pairs = meeting(apart, roots).join(tried, ["a", "b"], "left_anti")
    return found.unionByName(linked(staging.stage(pairs, "near-copies-rest"), sets))


def groups(
    df: DataFrame, text: str = "text", id: str = "doc_id", search: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``id, component`` for every row with an id; a component is named by its smallest id. ``search`` gives
    rows ``id, fingerprint, proofs`` and more their ``component``, which is taken as one more band."""
    rows = df.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text")).where("id IS NOT NULL")
    prints = staging.stage(sketches(rows), "near-copies-sketches")
    distinct = prints.groupBy("key").agg(
        F.min("id").alias("node"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    distinct = staging.stage(distinct, "near-copies-distinct")
    keyed = distinct.select("node", "size", F.explode("bands").alias("band"))
    if search is not None:
        keyed = keyed.unionByName(searched(prints, distinct, search))
    keyed = staging.stage(keyed, "near-copies-bands")
    # rows of one id may have other texts, and so other sets
    ids = prints.select("id", "key").distinct().join(distinct.select("key", "node"), "key").where("id != node")
    many = prints.groupBy("id").agg(F.count_distinct("key").alias("keys")).where("keys > 1").select("id")
    same = ids.join(many, "id", "left_semi").select(F.col("node").alias("a"), F.col("id").alias("b"))
    roots = components.connected(links(keyed, rows).unionByName(same))
    named = distinct.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("component"), "n")
    facts = staging.stage(named, "near-copies-components")
    total = facts.agg(F.sum("n")).first()[0] or 0
    return skew.attach(prints.select("id", "key"), facts, "key", total, "inner").select("id", "component")
