"""SimHash near-duplicates with pigeonring filtering.

A text's fingerprint has a bit set if more than half of the hashes of its word shingles have it.
Fingerprints that differ in at most ``distance`` bits are linked, and a component is all that links
reach.

Search: equal fingerprints become one first. The 64 bits form a ring of ``distance + 1`` segments.
If two fingerprints differ in at most ``distance`` bits, then from some segment on, the first ``l``
consecutive segments together differ in at most ``l * distance / segments`` bits, rounded down,
for every ``l``. The first segment of such a chain is therefore equal on both sides, which is what
candidates are grouped by; the chain prunes them before all 64 bits are compared. Within a group
only links to one member per component are handed on.

A group that holds more than a thousandth of all rows (so there are few) is split further: the
next segment may differ in the chain's second budget only, so its members are grouped again by
that segment with as many bits left out, one group for each choice of bits. Groups are read as a
stream of sorted rows; large ones are searched by looking their possible neighbours up instead of
comparing pairs.

Defined results: words are runs without ASCII white space, A-Z in lower case; a text with fewer
words than a shingle has one shingle, all its words; a null or empty text or one without words has
fingerprint 0, which is linked like any other; texts of any length are read whole; repeated rows
are each in the result, and rows with a null id are never representatives (their component is
null if no row with an id is reachable); an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import staging
from corpusmill.llm import common, components, near_copies, sieve, skew
from corpusmill.llm.shingles import SEED, fingerprint, shingle_hashes, words_of

SHINGLE = near_copies.FINGERPRINT_SHINGLE
DISTANCE = 2
#: Groups of so many members at most are never split or searched by look-up.
PAIRWISE = 1500
#: Larger groups are searched by look-up if they have so many members for each difference to look up.
LOOKUP = 2
#: ``proofs`` are further fingerprints, of other shingles, that linked rows must agree on.
FIELDS = common.struct(fingerprint=common.LONG, proofs=T.ArrayType(common.LONG))


class Proof(NamedTuple):
    """Fingerprints of ``shingle`` words, one for each seed; linked texts differ in at most
    ``1 - similarity`` of their bits."""

    shingle: int
    similarity: float
    seeds: tuple[int, ...]

    def budget(self) -> int:
        return int((1 - self.similarity) * 64 * len(self.seeds) + 1e-9)


#: Five words, similarity 0.8, in 128 bits.
FIVE_WORDS = Proof(5, 0.8, (SEED, SEED + 1))


def fingerprints(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    shingle: int = SHINGLE,
    proof: Proof | None = None,
) -> DataFrame:
    """``row`` and ``result`` (``FIELDS``) for every row."""

    def start():
        def compute(texts: list[str]) -> dict[str, pa.Array]:
            prints, proofs = [], []
            for text in texts:
                words = words_of(text)
                prints.append(fingerprint(shingle_hashes(words, shingle)))
                proofs.append([fingerprint(shingle_hashes(words, proof.shingle, s)) for s in proof.seeds] if proof else [])
            return {"fingerprint": pa.array(prints, pa.int64()), "proofs": pa.array(proofs, pa.list_(pa.int64()))}

        return compute

    return common.annotate(df, start, FIELDS, text, keep)


def segments_of(distance: int) -> list[tuple[int, int]]:
    """``(lowest bit, width)`` of the segments of the ring."""
    n = distance + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def mask(low: int, width: int) -> int:
    return ((1 << width) - 1) << low


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def chained(diff: np.ndarray, first: np.ndarray, distance: int) -> np.ndarray:
    """Whether the differing bits stay within the budget of every chain from segment ``first`` on."""
    ring = segments_of(distance)
    counts = np.stack([np.bitwise_count(diff & np.uint64(mask(*s))) for s in ring])
    passed, total = np.ones(len(diff), bool), np.zeros(len(diff), np.int64)
    for length in range(1, len(ring) + 1):
        total += counts[(first + length - 1) % len(ring), np.arange(len(diff))]
        passed &= total <= length * distance // len(ring)
    return passed


def neighbours(first: int, distance: int) -> np.ndarray:
    """All differences that a chain from segment ``first`` on allows."""
    ring = segments_of(distance)
    open_bits = [b for i, (low, width) in enumerate(ring) if i != first for b in range(low, low + width)]
    found = [sum(1 << b for b in chosen) for size in range(distance + 1) for chosen in combinations(open_bits, size)]
    values = np.array(found, np.uint64)
    return values[chained(values, np.full(len(values), first), distance)]


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of ``n`` nodes reaches over the edges ``a[i], b[i]``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for side in (a, b):
            np.minimum.at(root, side, low)
            np.minimum.at(root, before[side], low)
        root = root[root]
        if (root == before).all():
            return root


def links(
    group: np.ndarray, first: np.ndarray, prints: np.ndarray, proofs: np.ndarray, distance: int, budget: int
) -> tuple[np.ndarray, np.ndarray]:
    """Indices of linked rows. Rows of a group are neighbours; ``first`` is the group's segment,
    the rows of ``proofs`` may differ in ``budget`` bits."""

    def proven(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(proofs[a] ^ proofs[b]).sum(1, dtype=np.int64) <= budget

    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(group)))
    left, right = [], []
    ends = np.repeat(starts + sizes, sizes)
    sought = {int(f): neighbours(int(f), distance) for f in np.unique(first[starts[sizes > PAIRWISE]])}
    limits = np.array([max(PAIRWISE, LOOKUP * len(sought.get(f, ()))) for f in range(distance + 1)])
    large = sizes > limits[first[starts]]
    here, step = np.flatnonzero(np.repeat(~large, sizes)), 1
    while True:
        here = here[here + step < ends[here]]
        if not len(here):
            break
        diff = prints[here] ^ prints[here + step]
        near = np.flatnonzero(np.bitwise_count(diff) <= distance + 4)  # cheap, before the chains
        near = near[chained(diff[near], first[here[near]], distance)]
        near = near[np.bitwise_count(diff[near]) <= distance]
        near = near[proven(here[near], here[near] + step)]
        left.append(here[near])
        right.append(here[near] + step)
        step += 1
    for start, size in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
        own = prints[start : start + size]
        order = np.argsort(own)
        ranked = own[order]
        for difference in sought[int(first[start])]:
            wanted = own ^ difference
            at, stop = np.searchsorted(ranked, wanted), np.searchsorted(ranked, wanted, "right")
            here = np.flatnonzero(at < stop)
            while len(here):  # rows with equal fingerprints but other proofs come one after the other
                a, b = start + here, start + order[at[here]]
                good = proven(a, b) & (a != b)
                left.append(a[good])
                right.append(b[good])
                at[here] += 1
                here = here[at[here] < stop[here]]
    return np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *right])


def search(distance: int, proofs: int, budget: int):
    """Reads rows ``group, part, first, fingerprint, node`` and ``proofs`` more numbers, sorted by
    group and part, and yields the edges of a spanning forest of each group's links."""

    def edges(group, first, prints, nodes, *proof) -> pa.RecordBatch | None:
        agreed = np.stack(proof, axis=1).view(np.uint64) if proof else np.zeros((len(group), 0), np.uint64)
        a, b = links(group, first, prints.view(np.uint64), agreed, distance, budget)
        if not len(a):
            return None
        root = roots_of(len(group), a, b)
        away = np.flatnonzero(root != np.arange(len(group)))
        return pa.RecordBatch.from_pydict({"a": pa.array(nodes[away]), "b": pa.array(nodes[root[away]])})

    def run(batches):
        held: list[tuple] = []
        rows = 0

        def flush(last: bool):
            """All held groups but the last, which may go on, unless nothing follows."""
            nonlocal held, rows
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            group, part = columns[0], columns[1]
            change = np.concatenate([[True], (group[1:] != group[:-1]) | (part[1:] != part[:-1])])
            cut = len(group) if last else int(np.flatnonzero(change)[-1])
            held = [tuple(c[cut:] for c in columns)]
            rows = len(group) - cut
            if cut:
                return edges(np.cumsum(change)[:cut], *(c[:cut] for c in columns[2:]))
            return None

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(5 + proofs)))
                rows += batch.num_rows
                if rows >= 1 << 16 and len(held) >= 2 and rows >= 2 * len(held[0][0]):
                    found = flush(False)
                    if found is not None:
                        yield found
        if rows:
            found = flush(True)
            if found is not None:
                yield found

    return run


def near_links(prints: DataFrame, distance: int = DISTANCE, proof: Proof | None = None) -> DataFrame:
    """Edges ``a, b`` that connect all rows of ``prints`` (``fingerprint, proofs, node``, distinct
    but for the node) which are linked."""
    proven = [f"proof{i}" for i in range(len(proof.seeds) if proof else 0)]
    prints = prints.select("fingerprint", "node", *(F.col("proofs")[i].alias(c) for i, c in enumerate(proven)))
    ring = segments_of(distance)
    wide = F.col("fingerprint")
    keys = [
        F.struct(
            F.lit(i).alias("first"),
            F.concat_ws(":", F.lit(i), wide.bitwiseAND(F.lit(signed(mask(low, width)))).cast("string")).alias("key"),
        )
        for i, (low, width) in enumerate(ring)
    ]
    keyed = prints.select("*", F.explode(F.array(*keys)).alias("k")).select(
        *prints.columns, F.col("k.first").alias("first"), F.xxhash64("k.key").alias("group")
    )
    total = prints.count()
    counts = keyed.groupBy("group").count().where("count > 1")
    facts = staging.stage(counts.withColumn("hot", F.col("count") > F.lit(max(total // skew.HOT_PARTS, PAIRWISE))), "simhash-groups")
    hot = F.broadcast(facts.where("hot").select("group"))  # at most HOT_PARTS for each segment
    plain = keyed.join(hot, "group", "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    split = keyed.join(hot, "group", "left_semi")
    for i, (_, _) in enumerate(ring):
        low, width = ring[(i + 1) % len(ring)]
        budget = 2 * distance // len(ring)
        choices = [sum(1 << (low + b) for b in chosen) for chosen in combinations(range(width), budget)]
        parts = F.transform(
            F.array(*(F.lit(signed(mask(low, width) & ~c)) for c in choices)),
            lambda m: F.xxhash64(m, F.col("fingerprint").bitwiseAND(m)),
        )
        plain = plain.unionByName(split.where(F.col("first") == i).withColumn("part", F.explode(parts)))
    columns = ["group", "part", "first", "fingerprint", "node", *proven]
    dealt = plain.select(*columns).repartition(F.col("group"), F.col("part")).sortWithinPartitions("group", "part")
    return dealt.mapInArrow(search(distance, len(proven), proof.budget() if proof else 0), "a bigint, b bigint")


def with_components(prints: DataFrame, distance: int = DISTANCE, proof: Proof | None = None) -> DataFrame:
    """Staged rows ``id, fingerprint, proofs`` and more, with their ``component``."""
    key = F.xxhash64("fingerprint", "proofs")
    prints = prints.withColumn("key", F.col("fingerprint") if proof is None else key)
    distinct = staging.stage(
        prints.groupBy("key", "fingerprint", "proofs").agg(F.min("id").alias("node"), F.count("*").alias("n")),
        "simhash-distinct",
    )
    nodes = distinct.where("node IS NOT NULL")
    roots = components.connected(near_links(nodes, distance, proof))
    named = distinct.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("component"), "n")
    facts = staging.stage(named, "simhash-components")
    total = facts.agg(F.sum("n")).first()[0] or 0
    return skew.attach(prints, facts, "key", total, "inner").drop("key")


def group_prints(prints: DataFrame, distance: int = DISTANCE, proof: Proof | None = None) -> DataFrame:
    """``id, fingerprint, component`` for staged rows ``id, fingerprint, proofs``."""
    return with_components(prints, distance, proof).select("id", "fingerprint", "component")


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    proof: Proof | None = None,
) -> DataFrame:
    """``id, fingerprint, component`` for every row; a component is named by its smallest id."""
    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    made = fingerprints(rows, "text", ["id"], shingle, proof).select(
        F.col("row.id").cast("bigint").alias("id"), "result.fingerprint", "result.proofs"
    )
    return group_prints(staging.stage(made, "simhash-prints"), distance, proof)


def drop_near_duplicates(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row of each group of near copies, the one with the smallest id (of rows with that id, the
    first in order of their text), all columns. Rows with a null id belong to no group and stay.

    Candidates are the components of fingerprints that this module links and, as copies may differ in
    more bits, the bands of ``near_copies``; the exact similarity there decides on both.
    """
    made = staging.stage(near_copies.groups(df, text, id, with_components), "near-copies-made")
    gone = staging.stage(made.where("id != component").select(F.col("id").alias("__id")).distinct(), "near-copies-gone")
    again = made.where("id = component").groupBy(F.col("id").alias("__id")).count().where("count > 1").select("__id")
    again = staging.stage(again, "near-copies-again")
    packed = df.select(F.col(f"`{id}`").cast("bigint").alias("__id"), F.struct("*").alias("row"))
    stay = sieve.outside(packed, gone, "__id")
    if again.isEmpty():
        return stay.select("row.*")
    order = F.struct(F.col("row").getField(text))
    first = sieve.among(stay, again, "__id").groupBy("__id").agg(F.min_by("row", order).alias("row"))
    return sieve.outside(stay, again, "__id").select("row.*").unionByName(first.select("row.*"))
