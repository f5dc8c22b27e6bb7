"""Quality rules as weak supervision.

Each rule votes good, bad or abstains on a text. Expectation-maximisation over the counts of vote
patterns in the whole corpus estimates how often each rule is right and how common good texts are;
a text is kept if its posterior probability of being good reaches a threshold and it does not fail
the two base limits.

There are at most 3 ** rules vote patterns, whatever the corpus holds, so their counts are the only
thing that reaches the driver, and the table of posteriors is the only thing that is broadcast.

Defined results: a null or empty text has no words, fails the base limits and is not kept; words
are runs without ASCII white space in texts of any length; repeated rows get equal results; an
empty table gives an empty table. Other columns are left alone.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import common

SYMBOLS = b"#*$%&|<>"
#: Frequent short words of the languages that the corpus is meant to hold.
STOP_WORDS = (
    "the of and to a in is it that was for on with as by be this are from or an at "
    "der die und das nicht ein eine zu den mit von im sich auf dem als für ist "
    "le la les de des et un une en du que qui pour dans par sur au "
    "el los las y en del se por con su una lo es"
).split()

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_shouted n_marked n_stop n_ended_lines n_echo"
).split()
FIELDS = common.struct(**{name: common.LONG for name in COUNTS})


def repeated_words(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words of each text inside a 3-word window found twice or more in that text.

    ``words`` are numbers below 2 ** 21 of all texts one after the other.
    """
    doc = np.repeat(np.arange(len(lengths)), lengths)
    total = len(words)
    if total < 3:
        return np.zeros(len(lengths), np.int64)
    key = (words[:-2] << 42) | (words[1:-1] << 21) | words[2:]
    inside = np.flatnonzero(doc[:-2] == doc[2:])
    key, owner = key[inside], doc[inside]
    order = np.lexsort((key, owner))
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = inside[order[twice]]
    covered = np.zeros(total, bool)
    for shift in range(3):
        covered[starts + shift] = True
    return np.bincount(doc[covered], minlength=len(lengths))


def _start():
    spaces = bytes(c for c in range(256) if c not in b"\t\n\x0b\x0c\r ")
    unwanted = bytes(c for c in range(256) if c not in SYMBOLS)
    stop = {w.encode() for w in STOP_WORDS}

    def compute(texts: list[str]) -> dict[str, pa.Array]:
        numbers = defaultdict(count().__next__)
        per_text, ids, lengths = [], [], []
        repeats = []
        for text in texts:
            raw = text.encode()
            words = raw.split()
            if len(numbers) + len(words) >= 1 << 21:
                repeats.append(repeated_words(np.array(ids, np.int64), np.array(lengths, np.int64)))
                ids, lengths, numbers = [], [], defaultdict(count().__next__)
            if len(words) >= 1 << 21:
                repeats.append(np.array([long_repeats(words)]))
            else:
                mine = list(map(numbers.__getitem__, words))
                ids += mine
                lengths.append(len(words))
            lines = [line for line in raw.split(b"\n") if line.strip(b"\t\x0b\x0c\r ")]
            white = len(raw.translate(None, spaces))
            symbols = len(raw.translate(None, unwanted))
            marked = sum(map(raw.count, (b"# ", b"$ ", b"% ", b"& ", b"* ", b"! ", b"| "))) if symbols or b"!" in raw else 0
            per_text.append(
                (
                    len(words),
                    len(text) - white,
                    symbols,
                    len(lines) - len(set(lines)),
                    len(lines),
                    sum(map(bytes.isupper, words)),
                    marked,
                    sum(map(stop.__contains__, words)),
                    sum(line.rstrip().endswith((b".", b"!", b"?", b'"', b":")) for line in lines),
                    sum(map(bytes.__eq__, words, words[1:])),
                )
            )
        repeats.append(repeated_words(np.array(ids, np.int64), np.array(lengths, np.int64)))
        names = (
            "n_words word_chars n_symbols n_dup_lines n_lines n_shouted n_marked n_stop n_ended_lines n_echo"
        ).split()
        out = {n: pa.array([row[i] for row in per_text], pa.int64()) for i, n in enumerate(names)}
        return out | {"n_repeat_words": pa.array(np.concatenate(repeats).astype(np.int64))}

    return compute


def long_repeats(words: list[bytes]) -> int:
    """``n_repeat_words`` of one text with more words than numbers."""
    seen: dict[tuple[bytes, bytes, bytes], int] = defaultdict(int)
    for window in zip(words, words[1:], words[2:], strict=False):
        seen[window] += 1
    covered = bytearray(len(words))
    for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if seen[window] > 1:
            covered[i : i + 3] = b"\1\1\1"
    return sum(covered)


def measure(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` and ``result`` (``FIELDS``) for every text."""
    return common.annotate(df, _start, FIELDS, text, keep)


def rules(m: Column) -> dict[str, Column]:
    """The votes on a struct of ``FIELDS``: 1 good, -1 bad, 0 abstains."""
    words = F.greatest(m.n_words, F.lit(1))
    lines = F.greatest(m.n_lines, F.lit(1))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    symbols, marked, shouted = m.n_symbols / words, m.n_marked / words, m.n_shouted / words
    stop, repeated, echo = m.n_stop / words, m.n_repeat_words / words, m.n_echo / words
    mean = m.word_chars / words
    return {
        "length": vote(m.n_words < 10, m.n_words >= 100),
        "symbols": vote(symbols > 0.1, symbols < 0.01),
        "marked_words": vote(marked > 0.15, marked < 0.02),
        "shouting": vote(shouted > 0.3, shouted < 0.05),
        "stop_words": vote(stop < 0.02, stop > 0.06),
        "repeats": vote(repeated > 0.5, repeated < 0.05),
        "echoes": vote(echo > 0.3, echo < 0.05),
        "word_length": vote((mean < 2.5) | (mean > 12), (mean >= 3) & (mean <= 10)),
        "repeated_lines": vote(m.n_dup_lines / lines > 0.4, m.n_dup_lines == 0),
        "ended_lines": vote(m.n_ended_lines / lines < 0.3, m.n_ended_lines / lines > 0.7),
    }


def estimate(votes: np.ndarray, weights: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of each vote pattern, accuracy of each rule and share of good texts.

    The model: every rule votes bad, abstains or votes good with probabilities of its own for good
    and for bad texts, independently of the other rules. It starts from the number of bad votes. A
    rule that comes out more hostile to good texts than to bad ones is ignored, so good and bad
    cannot change places; counts are smoothed, so a corpus of one kind gives finite results.

    A rule's accuracy is its share of right votes among those it casts.
    """
    outcomes = np.stack([votes == v for v in (-1, 0, 1)]).astype(float)  # outcome, pattern, rule
    posterior = 1 / (1 + np.exp(4.0 * (votes < 0).sum(1) - 3.0))
    total = max(weights.sum(), 1.0)
    share = 0.5
    for _ in range(rounds):
        share = float(np.clip((weights * posterior).sum() / total, 0.02, 0.98))
        chances = []
        for belief, vague in ((posterior, (0.02, 0.18, 0.8)), (1 - posterior, (0.3, 0.5, 0.2))):
            mass = np.einsum("opr,p->or", outcomes, weights * belief) + 10 * np.array(vague)[:, None]
            chances.append(mass / mass.sum(0))
        good, bad = chances
        evidence = np.where(good[0] <= bad[0], np.log(good / bad), 0)
        odds = np.einsum("opr,or->p", outcomes, evidence) + np.log(share / (1 - share))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        settled = np.abs(new - posterior).max(initial=0) < 1e-10
        posterior = new
        if settled:
            break
    right = share * good[2] + (1 - share) * bad[0]
    cast = right + share * good[0] + (1 - share) * bad[2]
    return posterior, right / cast, share


def judge(df: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """``row``, ``result`` (``FIELDS``), ``base_failed``, ``posterior`` and ``kept``."""
    spark = df.sparkSession
    m = F.col("result")
    names = list(rules(m))
    pattern = F.concat_ws(",", *(v.cast("string") for v in rules(m).values()))
    base = (m.n_words < 50) | (100 * m.n_repeat_words > 50 * m.n_words)
    measured = staging.stage(
        measure(df, text, keep).select("row", "result", base.alias("base_failed"), pattern.alias("pattern")), "quality-rules"
    )
    patterns = [(r.pattern, r["count"]) for r in measured.groupBy("pattern").count().collect()]  # at most 3 ** rules
    votes = np.array([[int(v) for v in p.split(",")] for p, _ in patterns]).reshape(-1, len(names))
    posterior, _, _ = estimate(votes, np.array([n for _, n in patterns], float))
    table = spark.createDataFrame(
        [(p, float(x)) for (p, _), x in zip(patterns, posterior, strict=True)], "pattern string, posterior double"
    )
    joined = measured.join(F.broadcast(table), "pattern")
    kept = ~F.col("base_failed") & (F.col("posterior") >= threshold)
    return joined.select("row", "result", "base_failed", "posterior", kept.alias("kept"))
