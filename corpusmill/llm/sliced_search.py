"""Ranked lexical search over bit-sliced Bloom signatures.

Every document has a Bloom signature of its terms, ``HASHES`` bits for each; a term is entered once more
for each further frequency in ``LEVELS`` that it reaches. Documents with signatures of one length are
kept together in blocks, sliced: row b of a block is a bitmap of the documents that have bit b. The
rows of a term's bits, and-ed, give all documents that may hold the term so often, and a few that do not.

A search runs in blocks of items. It counts exactly how many documents hold each term; sums, for every
item and document, the weight of each term that may be there times the most it can add at the highest
level that it seems to reach, which is never less than the true score; scores exactly the documents
with the highest sums, so that the tenth best of them is a score to beat; and then scores exactly
every document whose sum reaches that score. No other document can be among the best.

The score of a document for an item sums ``w * (10**9 * tf div (1000 * tf + 8 * m))`` over the item's
terms, repeats included, ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and
``m = 25 + 75 * n * N div L``; N documents with terms, L terms in all, n in the document.

Memory: a task holds signatures of one block per length while it builds them, and the items' terms, at
most ``ITEM_BYTES`` of them, and one item, together. Of candidates nothing reaches the driver; they are
broadcast if they are few (``CLOSE``), else joined by a shuffle.

Defined results: terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in
lower case; null and empty texts and texts without terms count nowhere and are never listed, nor are
documents without an id, which do count; rows with one id are ranked one by one; equal scores are
ordered by id; each row of items gets a list of its own, items without terms an empty one; texts of any length are
read whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import common
from corpusmill.operators import ordering

BEST = 10
#: Frequencies from which on a term is entered once more.
LEVELS = (1, 2, 3, 5, 9)
HASHES = 6
#: A signature has so many bits for each entry at least, and up to twice as many. One term too many can
#: lift a sum above the score to beat, so false positives, at most one in a thousand, cost exact scores.
BITS = 16
#: A block is complete with so many bytes of slices or documents.
BLOCK_BYTES = 1 << 17
BLOCK_ROWS = 1024
#: Bytes of items that are searched for together; each counts as ``ITEM_COST`` bytes more.
ITEM_BYTES = 1 << 17
ITEM_COST = 64
#: Terms whose bitmaps are unpacked together.
TERMS = 1024
#: Candidates that are few enough to be broadcast, at most some 16 MB.
CLOSE = 1_000_000

INDEX = "bits int, ids array<bigint>, lengths array<bigint>, most array<bigint>, slices binary"
SCALE = 1_000_000_000

_KEPT = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
FOLD = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in _KEPT else 0x20 for c in range(256))
_FIRST, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Scores that a task hands on together.
SCORED = 50_000


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def entries(terms: list[bytes], level: int) -> np.ndarray:
    """Hashes of terms that reach the frequency ``LEVELS[level]``."""
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(t, level) for t in terms], np.uint64)


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The ``HASHES`` bits of each entry in signatures of ``bits``, a power of two."""
    first, step = hashes * _FIRST, (hashes * _STEP) | np.uint64(1)
    each = first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (each >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int32)


class Signed(NamedTuple):
    """A document of a block to be: its id, number of terms, largest frequency, and set bits."""

    id: int
    length: int
    most: int
    bits: np.ndarray


def sliced(bits: int, documents: list[Signed]) -> dict[str, list]:
    """A row of the index."""
    table = np.zeros((bits, len(documents)), bool)
    for i, document in enumerate(documents):
        table[document.bits, i] = True
    return {
        "bits": [bits],
        "ids": [[d.id for d in documents]],
        "lengths": [[d.length for d in documents]],
        "most": [[d.most for d in documents]],
        "slices": [np.packbits(table, axis=1).tobytes()],
    }


def build_index(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Sliced signatures of all documents (``INDEX``), a row for each block."""
    rows = df.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text")).where("id IS NOT NULL")
    layout = pa.schema(
        [("bits", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("ids", "lengths", "most")), ("slices", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list[Signed]] = {}
        for batch in common.slices(batches, lambda b: b.column(1)):
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms = terms_of(text)
                if not terms:
                    continue
                counts = Counter(terms)
                hashed = [entries(list(counts), 0)]
                for level, least in enumerate(LEVELS[1:], 1):
                    hashed.append(entries([t for t, tf in counts.items() if tf >= least], level))
                whole = np.concatenate(hashed)
                bits = 1 << max(6, (BITS * len(whole) - 1).bit_length())
                found = places(whole, bits).ravel()
                block = open_.setdefault(bits, [])
                block.append(Signed(number, len(terms), max(counts.values()), found))
                if len(block) >= BLOCK_ROWS or len(block) * bits >= 8 * BLOCK_BYTES:
                    yield pa.RecordBatch.from_pydict(sliced(bits, open_.pop(bits)), layout)
        for bits, block in open_.items():
            yield pa.RecordBatch.from_pydict(sliced(bits, block), layout)

    return rows.mapInArrow(run, INDEX)


class Items(NamedTuple):
    """Items searched for together: their terms, weights of terms, and which item has which how often;
    documents with terms and terms of all documents."""

    terms: list[bytes]
    weights: np.ndarray
    item: np.ndarray
    term: np.ndarray
    times: np.ndarray
    size: int
    documents: int
    total: int


def statistics(df: DataFrame, terms: list[bytes], text: str) -> tuple[int, int, list[int]]:
    """Documents with terms, all their terms, and how many documents hold each of ``terms``."""
    numbers = {t: i for i, t in enumerate(terms)}

    def run(batches):
        held: Counter[int] = Counter()
        for batch in common.slices(batches, lambda b: b.column(0)):
            for text in batch.column(0).to_pylist():
                found = terms_of(text)
                if found:
                    held[-1] += 1
                    held[-2] += len(found)
                    held.update([numbers[t] for t in numbers.keys() & set(found)])
        yield pa.RecordBatch.from_pydict({"term": pa.array(held.keys(), pa.int64()), "n": pa.array(held.values(), pa.int64())})

    counted = df.select(F.col(f"`{text}`")).mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counted.collect()}  # two numbers and one for each term of the items
    return found.get(-1, 0), found.get(-2, 0), [found.get(i, 0) for i in range(len(terms))]


def weigh(df: DataFrame, texts: list[str | None], text: str) -> Items:
    counts = [Counter(terms_of(t)) for t in texts]
    terms = sorted(set().union(*counts))
    number = {t: i for i, t in enumerate(terms)}
    n, total, df_of = statistics(df, terms, text)
    flat = [(i, number[t], times) for i, c in enumerate(counts) for t, times in c.items()]
    item, term, times = (np.array(x, np.int64) for x in zip(*flat, strict=True)) if flat else np.zeros((3, 0), np.int64)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df_of], np.int64)
    return Items(terms, weights, item, term, times, len(texts), n, total)


def damping(lengths: np.ndarray, items: Items) -> np.ndarray:
    return 25 + 75 * lengths * items.documents // items.total


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a weight is multiplied by."""
    return SCALE * tf // (1000 * tf + 8 * m)


class Bounds:
    """Upper bounds of the scores of all documents of a block, for all items."""

    def __init__(self, items: Items):
        self.items = items
        self.hashes = [entries(items.terms, level) for level in range(len(LEVELS))]
        self.weight = np.zeros((items.size, len(items.terms)), np.float32)
        self.weight[items.item, items.term] = items.times * items.weights[items.term]
        # sums of rounded numbers above 0 are off by so much at most, each way
        self.margin = 1 + (len(items.terms) + 8) * 2.0**-22

    def of(self, bits: int, lengths: np.ndarray, most: np.ndarray, slices: bytes) -> np.ndarray:
        table = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        m = damping(lengths, self.items)
        # the most that a term adds at each level; the first stands for no level at all
        tops = [np.minimum(high - 1, most) for high in LEVELS[1:]] + [most]
        adds = np.stack([np.zeros(len(m)), *(part(top, m) for top in tops)]).astype(np.float32)
        every, out = np.arange(len(m)), np.zeros((self.items.size, len(m)), np.float64)
        for low in range(0, len(self.items.terms), TERMS):
            reached = np.zeros((min(TERMS, len(self.items.terms) - low), len(m)), np.uint8)
            passed = np.uint8(255)
            for hashes in self.hashes:
                at = places(hashes[low : low + TERMS], bits)
                passed = passed & np.bitwise_and.reduce(table[at], axis=1)
                if not passed.any():
                    break
                reached += np.unpackbits(passed, axis=1, count=len(m))
            out += self.weight[:, low : low + TERMS] @ adds[reached, every]
        return out * self.margin


def read_blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            row = [batch.column(c)[i] for c in range(5)]
            ids, lengths, most = (x.values.to_numpy(zero_copy_only=False) for x in row[1:4])
            yield row[0].as_py(), ids, lengths, most, row[4].as_py()


def highest(index: DataFrame, items: Items) -> DataFrame:
    """``item, id, bound``: for each item the documents of each task with the highest bounds."""

    def run(batches):
        bounds = Bounds(items)
        held_ids, held = np.zeros((items.size, 0), np.int64), np.zeros((items.size, 0))
        for bits, ids, lengths, most, slices in read_blocks(batches):
            found = bounds.of(bits, lengths, most, slices)
            if found.shape[1] > BEST:
                top = np.argpartition(-found, BEST - 1, axis=1)[:, :BEST]
                ids, found = ids[top], np.take_along_axis(found, top, 1)
            else:
                ids = np.broadcast_to(ids, found.shape)
            held_ids, held = np.concatenate([held_ids, ids], axis=1), np.concatenate([held, found], axis=1)
            top = np.argsort(-held, axis=1)[:, :BEST]
            held_ids, held = np.take_along_axis(held_ids, top, 1), np.take_along_axis(held, top, 1)
        item, at = np.nonzero(held > 0)
        yield pa.RecordBatch.from_pydict({"item": item, "id": held_ids[item, at], "bound": held[item, at]})

    found = index.mapInArrow(run, "item bigint, id bigint, bound double")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "id"))
    return found.withColumn("place", place).where(F.col("place") <= BEST).drop("place")


def reaching(index: DataFrame, items: Items, beat: np.ndarray) -> DataFrame:
    """``item, id`` of all documents whose bound is above 0 and reaches the item's number in ``beat``."""

    def run(batches):
        bounds = Bounds(items)
        for bits, ids, lengths, most, slices in read_blocks(batches):
            found = bounds.of(bits, lengths, most, slices)
            item, at = np.nonzero((found >= beat[:, None]) & (found > 0))
            yield pa.RecordBatch.from_pydict({"item": item, "id": ids[at]})

    return index.mapInArrow(run, "item bigint, id bigint")


def score(df: DataFrame, wanted: DataFrame, items: Items, text: str, id: str) -> DataFrame:
    """``item, id, score`` above 0 of every document for the items that ``wanted`` (staged ``item, id``)
    names with its id; a row for each row with that id."""
    near = wanted.groupBy("id").agg(F.collect_set("item").alias("items"))
    rows = df.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    met = rows.join(F.broadcast(near) if wanted.count() <= CLOSE else near, "id").select("id", "items", "text")

    def run(batches):
        bounds = np.searchsorted(items.item, np.arange(items.size + 1))

        def scored():
            for batch in common.slices(batches, lambda b: b.column(2)):
                for number, asked, text in zip(*batch.columns, strict=True):
                    terms = terms_of(text.as_py())
                    if not terms:
                        continue
                    counts, m = Counter(terms), damping(np.int64(len(terms)), items)
                    for item in asked.as_py():
                        own = slice(bounds[item], bounds[item + 1])
                        term = items.term[own]
                        tf = np.array([counts.get(items.terms[t], 0) for t in term.tolist()], np.int64)
                        total = int((items.times[own] * items.weights[term] * part(tf, m)).sum())
                        if total > 0:
                            yield item, number.as_py(), total

        rows = scored()
        while held := list(islice(rows, SCORED)):
            item, number, total = (np.array(c, np.int64) for c in zip(*held, strict=True))
            yield pa.RecordBatch.from_pydict({"item": item, "id": number, "score": total})

    return met.mapInArrow(run, "item bigint, id bigint, score bigint")


def ranked(scores: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "id"))
    return scores.withColumn("rank", place).where(F.col("rank") <= BEST)


def search(
    df: DataFrame,
    index: DataFrame,
    items: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item, rank, id, score``: for each row of ``items`` the ``BEST`` documents of ``df`` with scores
    above 0. ``index`` is what ``build_index`` made of ``df``, staged."""
    spark = df.sparkSession
    asked = items.select(F.col(f"`{item}`").alias("name"), F.col(f"`{item_text}`").alias("text"))
    asked = staging.stage(asked.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + ITEM_COST), "search-items")
    summed = ordering.running_sums(asked, ["name", "text"], {"upto": "size"})
    dealt = staging.stage(summed.withColumn("block", F.expr(f"(upto - size) div {ITEM_BYTES}")), "search-blocks")
    last = dealt.agg(F.max("block")).first()[0]
    kind = asked.schema["name"].dataType.simpleString()
    found = []
    for block in range(0 if last is None else last + 1):
        rows = dealt.where(F.col("block") == block).select("name", "text").collect()  # ITEM_BYTES and one item at most
        own = weigh(df, [r.text for r in rows], text)
        if not own.terms or not own.total:
            continue
        tried = staging.stage(highest(index, own).select("item", "id"), "search-tried")
        known = ranked(score(df, tried, own, text, id)).where(F.col("rank") == BEST)
        beat = np.zeros(own.size)
        for r in known.select("item", "score").collect():  # one for each item
            beat[r.item] = r.score
        wanted = staging.stage(reaching(index, own, beat), "search-wanted")
        names = spark.createDataFrame([(i, r.name) for i, r in enumerate(rows)], f"item bigint, name {kind}")
        listed = ranked(score(df, wanted, own, text, id)).join(F.broadcast(names), "item")
        found.append(listed.select(F.col("name").alias("item"), "rank", "id", "score"))
    whole = spark.createDataFrame([], f"item {kind}, rank int, id bigint, score bigint")
    for one in found:
        whole = whole.unionByName(one)
    return whole
