"""Benchmark decontamination by greedy string tiling.

Windows of ``MIN_MATCH`` words that a text shares with a benchmark item are the seeds. For every
text and item that share one, the longest matches that do not overlap earlier ones are marked
again and again (Karp-Rabin hashes of all unmarked windows of one length, the length found by
bisection, hits confirmed word by word) until none of ``MIN_MATCH`` words is left. If the marked
tiles cover at least ``THRESHOLD`` of the item's words, in whatever order they stand, the text
holds the item.

The benchmark is read in blocks of about ``BLOCK_BYTES``; each block goes to the tasks as a whole
and all texts are compared with it, so neither texts nor seeds are shuffled.

Defined results: words are runs of letters, digits and underscores in lower case; a null or empty
text holds nothing; an item without words is never found, one of fewer than ``MIN_MATCH`` words
only where all its words stand in a row; equal items are all reported; ties go to the earliest
place in the item, then in the text; texts of any length are compared whole; repeated rows get
equal results; empty tables give no hits. Other columns are left alone.
"""

from __future__ import annotations

import re
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusmill.llm import common

MIN_MATCH = 5
THRESHOLD = 0.5
BLOCK_BYTES = 16 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be divided out
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def mixed(ids: np.ndarray) -> np.ndarray:
    """Spread word numbers over 64 bits."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


class Rolling:
    """Karp-Rabin hashes of all windows of a word sequence, for any length."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(ids) * powers(BASE, n)[:n], dtype=np.uint64)])
        self.down = powers(np.uint64(pow(int(BASE), -1, 1 << 64)), n)

    def windows(self, starts: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.down[starts]


def fixed_windows(ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of known words only (numbers of 0 or more)."""
    if len(ids) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    unknown = np.concatenate([[0], np.cumsum(ids < 0)])
    starts = np.flatnonzero(unknown[length:] == unknown[:-length])
    spread = np.zeros(len(starts), np.uint64)
    for step in range(length):
        spread = spread * BASE + mixed(ids[starts + step])
    return starts, spread


def tile(item: np.ndarray, text: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """``(start in item, start in text, length)`` of the tiles, in the order they were marked.

    Numbers below 0 in ``text`` match nothing.
    """
    tiles: list[tuple[int, int, int]] = []
    item_free, text_free = np.ones(len(item), bool), text >= 0
    left, right = Rolling(item), Rolling(text)

    def open_windows(rolling: Rolling, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        if len(free) < length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        taken = np.concatenate([[0], np.cumsum(~free)])
        starts = np.flatnonzero(taken[length:] == taken[:-length])
        return starts, rolling.windows(starts, length)

    def shared(length: int) -> bool:
        return bool(np.isin(open_windows(left, item_free, length)[1], open_windows(right, text_free, length)[1]).any())

    high = min(len(item), len(text))
    while high >= shortest and shared(shortest):
        low = shortest
        while low < high:  # the longest length at which a match is left
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        places: dict[int, list[int]] = {}
        starts, hashes = open_windows(right, text_free, low)
        for start, value in zip(starts.tolist(), hashes.tolist(), strict=True):
            places.setdefault(value, []).append(start)
        found = False
        starts, hashes = open_windows(left, item_free, low)
        for start, value in zip(starts.tolist(), hashes.tolist(), strict=True):
            if not item_free[start : start + low].all():
                continue
            for at in places.get(value, ()):
                if text_free[at : at + low].all() and (item[start : start + low] == text[at : at + low]).all():
                    item_free[start : start + low] = text_free[at : at + low] = False
                    tiles.append((start, at, low))
                    found = True
                    break
        high = low if found else low - 1
    return tiles


class Block(NamedTuple):
    """Part of the benchmark: word numbers, items and their seeds."""

    numbers: dict[str, int]
    items: list[np.ndarray]
    names: list[list]
    seeds: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # length, hashes, where, items


def prepare(rows: list[tuple[object, str]]) -> Block:
    """A block from ``(item id, text)``; items of equal words become one with several ids."""
    numbers: dict[str, int] = {}
    unique: dict[tuple[int, ...], list] = {}
    for name, text in rows:
        words = tuple(numbers.setdefault(w, len(numbers)) for w in words_of(text or ""))
        if words:
            unique.setdefault(words, []).append(name)
    items = [np.array(words, np.int64) for words in unique]
    seeds = []
    for length in sorted({min(MIN_MATCH, len(i)) for i in items}):
        found = [(k, np.unique(fixed_windows(i, length)[1])) for k, i in enumerate(items) if min(MIN_MATCH, len(i)) == length]
        hashes, owner = np.concatenate([h for _, h in found]), np.concatenate([np.full(len(h), k) for k, h in found])
        order = np.argsort(hashes, kind="stable")
        distinct, first = np.unique(hashes[order], return_index=True)
        seeds.append((length, distinct, np.append(first, len(order)), owner[order]))
    return Block(numbers, items, list(unique.values()), seeds)


def seeded(block: Block, words: list[list[str]]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray, int]]:
    """``(text, item)`` pairs that share a seed: the shared windows' starts, the text, their length."""
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    flat = chain.from_iterable(chain(own, ("",)) for own in words)  # no word between two texts
    ids = np.fromiter(map(block.numbers.get, flat, repeat(-1)), np.int64, int(lengths.sum()))
    begins = np.cumsum(lengths) - lengths
    pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, int]] = {}
    for length, hashes, first, owners in block.seeds:
        starts, spread = fixed_windows(ids, length)
        at = np.minimum(np.searchsorted(hashes, spread), len(hashes) - 1)
        hit = np.flatnonzero(hashes[at] == spread)
        if not len(hit):
            continue
        counts = first[at[hit] + 1] - first[at[hit]]
        item = owners[common.ragged(first[at[hit]], counts)]
        start = np.repeat(starts[hit], counts)
        text = np.searchsorted(begins, start, "right") - 1
        order = np.lexsort((start, item, text))
        item, start, text = item[order], start[order], text[order]
        edges = np.flatnonzero((np.diff(item) != 0) | (np.diff(text) != 0)) + 1
        for part in np.split(np.arange(len(item)), edges):
            k, d = int(item[part[0]]), int(text[part[0]])
            pairs[d, k] = (start[part] - begins[d], ids[begins[d] : begins[d] + lengths[d] - 1], length)
    return pairs


def leaks_of(block: Block, texts: list[str], threshold: float) -> list[list[dict]]:
    """What each text holds of the block's items."""
    out: list[list[dict]] = [[] for _ in texts]
    words = [words_of(t) for t in texts]
    for (d, k), (starts, ids, length) in seeded(block, words).items():
        item = block.items[k]
        near = np.unique((starts[:, None] + np.arange(length)).ravel())  # all words inside shared windows
        gap = np.concatenate([[False], np.diff(near) > 1])
        at = np.arange(len(near)) + np.cumsum(gap)  # one number below 0 between stretches
        held, places = np.full(at[-1] + 1, -1, np.int64), np.full(at[-1] + 1, -1, np.int64)
        held[at], places[at] = ids[near], near
        tiles = tile(item, held, length)
        covered = sum(n for _, _, n in tiles) / len(item)
        if covered >= threshold:
            found = [{"start": int(places[b]), "item_start": a, "length": n} for a, b, n in tiles]
            out[d] += [{"item": name, "covered": covered, "tiles": found} for name in block.names[k]]
    return out


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (the columns in ``keep``, else all) and ``leaks``: the benchmark items a text holds,
    each with the covered share and its tiles (word positions), ordered by item."""
    items = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("text")).where("text IS NOT NULL")
    name = items.schema["item"].dataType
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    leak = common.struct(item=name, covered=common.REAL, tiles=common.span(start=common.LONG, item_start=common.LONG, length=common.LONG))
    kept = [f for f in df.schema.fields if keep is None or f.name in keep or f.name == text]
    row = T.StructType(kept)
    fields = common.struct(row=row, leaks=T.ArrayType(leak))
    text_at = [f.name for f in kept].index(text)
    found = common.bound_batches(df).select(
        F.struct(*(F.col(f"`{f.name}`") for f in kept)).alias("row"), F.array().cast(T.ArrayType(leak)).alias("leaks")
    )
    for number in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == number)
        rows = sorted(((r.item, r.text) for r in mine.collect()), key=repr)  # one block, of bounded size
        found = found.mapInArrow(_compare(rows, text_at, threshold, to_arrow_type(T.ArrayType(leak))), fields)
    wanted = [f.name for f in kept if keep is None or f.name in keep]
    return found.select(
        F.struct(*(F.col("row").getField(n).alias(n) for n in wanted)).alias("row"), F.array_sort("leaks").alias("leaks")
    )


def _compare(rows: list[tuple[object, str]], text_at: int, threshold: float, kind: pa.DataType):
    def run(batches):
        block = prepare(rows)
        for batch in common.slices(batches, lambda b: b.column(0).field(text_at)):
            texts = [t or "" for t in batch.column(0).field(text_at).to_pylist()]
            found = leaks_of(block, texts, threshold)
            leaks = batch.column(1)
            if any(found):
                leaks = pa.array([a + b for a, b in zip(leaks.to_pylist(), found, strict=True)], kind)
            # always built alike: a batch as it came may differ in what may be null
            yield pa.RecordBatch.from_arrays([batch.column(0), leaks.cast(kind)], names=["row", "leaks"])

    return run
