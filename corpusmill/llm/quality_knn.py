"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms are the 3-grams of a text's character classes (letters by case, digits, white space, line
ends, single punctuation marks), plus marks for a word or a line that repeats its predecessor.
Term counts are damped, weighted by inverse document frequency and projected by the leading
singular vectors of a bounded sample of labelled rows. The vectors of that sample are broadcast;
every document is compared with all of them in blocks of exact cosine products, and its
``NEIGHBOURS`` closest vote with their similarity as weight.

The sample holds the ``SAMPLE`` labelled rows of each label with the smallest hash of the id, so
what reaches the driver and the executors is bounded: at most ``2 * SAMPLE`` vectors of ``TERMS``
counts, and of ``DIMENSIONS`` numbers.

All numbers that decide are multiples of fixed steps, small enough that their products and sums are exact,
so a text's score does not depend on what else is in its block.

Defined results: a null or empty text has the zero vector and gets the share of good rows in the
sample as its score, as does every text if nothing could be learned (0.5 without any label); equal
similarities are ordered by the sample's order; rows without a label teach nothing; an id with several
labels has the smallest of them, and one with several texts the smallest text; repeated rows get equal scores; texts of any length are read whole; an empty table gives an empty table. Other
columns are left alone.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import common

SAMPLE = 1500
DIMENSIONS = 48
NEIGHBOURS = 25
THRESHOLD = 0.7
#: Texts that are compared with the sample together.
BLOCK = 64
POWER = 8  # a neighbour's weight is its similarity to this power
#: Steps of term counts, of the projection and of the vectors' coordinates, each one over a power of two.
COUNT_STEP, PROJECT_STEP, VECTOR_STEP = 2.0**-12, 2.0**-20, 2.0**-15

CLASSES = 16
_OWN = b"#$%&*|!.,\"'"  # punctuation marks with a class of their own, in two groups of marks


def _classes() -> bytes:
    table = bytearray([15] * 256)
    for c in range(256):
        if c == 10:
            table[c] = 1
        elif c in b"\t\x0b\x0c\r ":
            table[c] = 0
        elif chr(c).isascii() and chr(c).islower() or c >= 0x80:
            table[c] = 2
        elif chr(c).isascii() and chr(c).isupper():
            table[c] = 3
        elif chr(c).isdigit():
            table[c] = 4
        elif c in _OWN:
            table[c] = 5 + min(_OWN.index(c), 9)
    return bytes(table)


GRAMS = CLASSES**3
TERMS = GRAMS + 2
FIELDS = common.struct(score=common.REAL)


def term_counts(texts: list[str], table: bytes) -> np.ndarray:
    """Counts of every term (columns) in every text (rows), damped by their logarithm, length 1."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for i, text in enumerate(texts):
        raw = text.encode()
        code = np.frombuffer(raw.translate(table), np.uint8).astype(np.int32)
        if len(code) >= 3:
            grams = (code[:-2] << 8) | (code[1:-1] << 4) | code[2:]
            out[i, :GRAMS] = np.bincount(grams, minlength=GRAMS)
        words, lines = raw.split(), raw.split(b"\n")
        out[i, GRAMS] = sum(map(bytes.__eq__, words, words[1:]))
        out[i, GRAMS + 1] = sum(map(bytes.__eq__, lines, lines[1:]))
    total = np.maximum(out.sum(1, keepdims=True), 1)
    return stepped(np.log1p(out * (1000 / total)), COUNT_STEP)


def stepped(values: np.ndarray, step: float) -> np.ndarray:
    """Each value as the nearest multiple of ``step``."""
    return np.rint(values / step) * step


class Model(NamedTuple):
    """``project`` takes term counts to vectors; ``vectors`` and ``labels`` are the sample's."""

    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def vectors_of(counts: np.ndarray, project: np.ndarray) -> np.ndarray:
    """Projected rows of length 1, in steps."""
    rows = np.ascontiguousarray(counts.astype(np.float64) @ project)
    return stepped(rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12), VECTOR_STEP)


def leading(rows: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """The ``size`` leading right singular vectors of ``rows``, as columns, by subspace iteration.

    Needs a few times ``size`` vectors beside ``rows`` and no square matrix of either side.
    """
    start = np.random.default_rng(0).standard_normal((rows.shape[1], size), np.float32)
    basis = np.linalg.qr(start)[0]
    for _ in range(rounds):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    turn = np.linalg.svd(rows @ basis, full_matrices=False)[2]
    return basis @ turn.T


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Latent-semantic vectors of the sample: inverse document frequencies and a truncated SVD."""
    n = len(labels)
    if not n:
        return Model(np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), 0.5)
    weight = (np.log((1 + n) / (1 + np.count_nonzero(counts, axis=0))) + 1).astype(np.float32)
    weighted = counts * weight
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
    project = stepped(weight[:, None].astype(np.float64) * leading(weighted, min(DIMENSIONS, n)), PROJECT_STEP)
    del weighted
    return Model(project, vectors_of(counts, project), labels.astype(np.float64), float(labels.mean()))


def vote(counts: np.ndarray, model: Model) -> np.ndarray:
    """Score of each row: the similarity-weighted share of label 1 among its nearest neighbours."""
    scores = np.full(len(counts), model.prior)
    if not len(model.labels):
        return scores
    vectors = vectors_of(counts, model.project)
    known = np.flatnonzero(np.abs(vectors).sum(1) > 0)
    size = len(model.labels)
    near, place = min(NEIGHBOURS, size), np.arange(size)
    for low in range(0, len(known), BLOCK):
        rows = known[low : low + BLOCK]
        steps = ((vectors[rows] @ model.vectors.T) / VECTOR_STEP**2).astype(np.int64)
        order = place - steps * size  # no two are equal: by similarity, then by place
        best = np.sort(np.partition(order, near - 1, axis=1)[:, :near], axis=1)
        at = best % size
        weight = np.maximum((at - best) // size * VECTOR_STEP**2, 0) ** POWER + 1e-12
        scores[rows] = np.clip((weight * model.labels[at]).sum(1) / weight.sum(1), 0, 1)
    return scores


def learn(
    documents: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", id: str = "doc_id"
) -> Model:
    """Fit on the ``SAMPLE`` rows of ``labels`` of each label (0 and 1) whose id hashes lowest.

    The sample is drawn from ids and labels alone and broadcast to the documents, so only the sample's
    texts are shuffled, one for each id and task at most; its term counts reach the driver.
    """
    own = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    single = own.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.min("label").alias("label"))
    known = single.withColumn("rank", F.xxhash64(F.col("id").cast("string")))
    parts = [known.where(F.col("label") == value).orderBy("rank", "id").limit(SAMPLE) for value in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * SAMPLE rows
    texts = documents.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sample = texts.join(chosen, "id").groupBy("id").agg(
        F.first("label").alias("label"), F.min("text").alias("text"), F.first("rank").alias("rank")
    )
    sample = sample.select("label", "text", "rank")
    table = _classes()

    def run(batches):
        for batch in common.slices(batches, lambda b: b.column(1)):
            counts = term_counts([t or "" for t in batch.column(1).to_pylist()], table)
            filled = [np.flatnonzero(c).astype(np.int32) for c in counts]
            yield pa.RecordBatch.from_pydict(
                {
                    "label": batch.column(0),
                    "rank": batch.column(2),
                    "terms": pa.array([f.tobytes() for f in filled], pa.binary()),
                    "weights": pa.array([c[f].tobytes() for c, f in zip(counts, filled, strict=True)], pa.binary()),
                }
            )

    taken = sample.mapInArrow(run, "label int, rank bigint, terms binary, weights binary")
    rows = sorted(((r.rank, r.label, r.terms, r.weights) for r in taken.collect()), key=lambda r: (r[0], r[1], bytes(r[2])))
    counts = np.zeros((len(rows), TERMS), np.float32)
    for i, (_, _, terms, weights) in enumerate(rows):
        counts[i, np.frombuffer(terms, np.int32)] = np.frombuffer(weights, np.float32)
    return fit(counts, np.array([x[1] for x in rows], np.float32))


def classify(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` and ``result`` (``score``) for every row."""
    table = _classes()
    parts = tuple(model)

    def start():
        fitted = Model(*parts)

        def compute(texts: list[str]) -> dict[str, pa.Array]:
            found = [vote(term_counts(texts[low : low + BLOCK], table), fitted) for low in range(0, len(texts), BLOCK)]
            return {"score": pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())}

        return compute

    return common.annotate(df, start, FIELDS, text, keep)
