"""Language identification with bit-sliced Bloom filters of n-grams.

Learning counts byte 4-grams (letters in lower case, anything else a space) per language over all
labelled texts. A language owns the n-grams that make up at least ``MIN_SHARE`` of its n-grams
and come at least ``RELATIVE`` as often there as in the language where they are most common; by
the pigeonhole principle these are at most ``1 / MIN_SHARE`` per language. One Bloom filter per
language is kept bit-sliced: a slot holds one bit per language, so ``HASHES`` look-ups return the
mask of all languages that may contain an n-gram. A prediction adds up the mask bits of a text per
language, takes off what false positives add, and names the language with most left.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text if
nothing was learned; rows with a null language teach nothing; of languages with equal counts the
alphabetically first is named; texts of any length are read whole; repeated rows count as often
as they come; an empty table gives an empty table. Other columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import common

GRAM = 4
MIN_SHARE = 1 / 20_000
RELATIVE = 0.2
HASHES = 2
SLOTS_PER_GRAM = 16
UNDETERMINED = "und"
FIELDS = common.struct(lang=common.TEXT, score=common.REAL)
#: ASCII letters and all bytes of other characters stay, the rest becomes a space.
SHAPE = bytes(c if chr(c).isalpha() or c >= 0x80 else 32 for c in range(256))
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams of all texts as numbers, and how many each text has."""
    shaped = [b" " + t.lower().encode().translate(SHAPE) + b" " for t in texts]
    lengths = np.array([len(s) for s in shaped], np.int64)
    raw = np.frombuffer(b"".join(shaped), np.uint8).astype(np.uint32)
    if len(raw) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    code = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    ends = np.cumsum(lengths)
    usable = np.ones(len(code), bool)
    for back in range(1, GRAM):
        at = ends - back
        usable[at[(at >= 0) & (at < len(code))]] = False
    blank = np.uint32(0x20202020)
    usable &= code != blank
    doc = np.repeat(np.arange(len(texts)), lengths)[: len(code)]
    return code[usable], np.bincount(doc[usable], minlength=len(texts))


def count_grams(df: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, gram, n`` over all labelled texts; every task sends one row per pair at most."""
    pairs = df.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))

    def run(batches):
        kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in common.slices(batches, lambda b: b.column(0)):
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name in sorted(set(langs)):
                codes, _ = grams_of([t or "" for t, own in zip(texts, langs, strict=True) if own == name])
                found, n = np.unique(codes, return_counts=True)
                if name in kept:
                    codes, n = np.concatenate([kept[name][0], found]), np.concatenate([kept[name][1], n])
                    found, where = np.unique(codes, return_inverse=True)
                    n = np.bincount(where, n, len(found)).astype(np.int64)
                kept[name] = (found, n)
        for name, (found, n) in kept.items():
            for low in range(0, len(found), 1 << 16):
                part = slice(low, low + (1 << 16))
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([name] * len(found[part]), pa.string()),
                        "gram": pa.array(found[part].astype(np.int64)),
                        "n": pa.array(n[part].astype(np.int64)),
                    }
                )

    counted = pairs.mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def slots_of(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    """``HASHES`` slots below ``2 ** bits`` for each n-gram."""
    wide = grams.astype(np.uint64)
    return [(wide * np.uint64(m)) >> np.uint64(64 - bits) for m in MULTIPLIERS[:HASHES]]


class Filters:
    """Bit-sliced Bloom filters: ``masks[slot]`` has the bits of the languages that set the slot."""

    def __init__(self, grams: dict[str, np.ndarray]):
        self.langs = sorted(grams)
        total = max(1, sum(map(len, grams.values())))
        self.bits = max(10, int(np.ceil(np.log2(total * SLOTS_PER_GRAM))))
        self.groups = []
        for low in range(0, len(self.langs), 64):
            names = self.langs[low : low + 64]
            masks = np.zeros(1 << self.bits, np.uint8 if len(names) <= 8 else np.uint64)
            for bit, name in enumerate(names):
                for slot in slots_of(grams[name], self.bits):
                    masks[slot] |= masks.dtype.type(1 << bit)
            dense = [float(((masks >> masks.dtype.type(bit)) & masks.dtype.type(1)).mean()) for bit in range(len(names))]
            self.groups.append((masks, [d**HASHES for d in dense]))

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits of each text (rows) in each language (columns), and its n-grams."""
        codes, lengths = grams_of(texts)
        starts = common.offsets(lengths)
        slots = slots_of(codes, self.bits)
        columns = []
        for masks, wrong in self.groups:
            found = masks[slots[0]]
            for slot in slots[1:]:
                found &= masks[slot]
            for bit, rate in enumerate(wrong):
                hit = np.concatenate([[0], np.cumsum((found >> found.dtype.type(bit)) & found.dtype.type(1), dtype=np.int64)])
                hits = hit[starts[1:]] - hit[starts[:-1]]
                columns.append(np.maximum((hits - rate * lengths) / max(1 - rate, 1e-9), 0))
        return np.array(columns).T.reshape(len(texts), len(self.langs)), lengths


def learn(
    df: DataFrame, text: str = "text", lang: str = "lang", least: float = MIN_SHARE, relative: float = RELATIVE
) -> Filters:
    """Filters from the labelled rows. At most ``1 / least`` n-grams per language reach the driver, which
    is what ``least`` is for; ``relative`` keeps out n-grams that mark another language."""
    counts = staging.stage(count_grams(df, text, lang), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total"))
    best = shares.groupBy("gram").agg(F.max("share").alias("best"), F.collect_list(F.struct("lang", "share")).alias("owners"))
    owned = (
        best.where(F.col("best") >= least)
        .select("gram", "best", F.explode("owners").alias("owner"))
        .where((F.col("owner.share") >= least) & (F.col("owner.share") >= relative * F.col("best")))
        .groupBy("owner.lang")
        .agg(F.collect_list("gram").alias("grams"))
    )
    return Filters({r.lang: np.array(r.grams, np.uint32) for r in owned.collect()})


def identify(df: DataFrame, filters: Filters, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` and ``result`` (``lang``, ``score``): the share of the language among all corrected hits."""

    def start():
        known = filters

        def compute(texts: list[str]) -> dict[str, pa.Array]:
            lettered = np.array([any(map(str.isalpha, t)) for t in texts])
            names, scores = np.array([UNDETERMINED] * len(texts), object), np.zeros(len(texts))
            if known.langs:
                hits, _ = known.counts(texts)
                best = hits.argmax(1)
                total = hits.sum(1)
                scores = np.where(lettered & (total > 0), hits.max(1) / np.maximum(total, 1e-9), 0.0)
                names[lettered] = np.array(known.langs, object)[best[lettered]]
            return {"lang": pa.array(names.tolist(), pa.string()), "score": pa.array(scores, pa.float64())}

        return compute

    return common.annotate(df, start, FIELDS, text, keep)
