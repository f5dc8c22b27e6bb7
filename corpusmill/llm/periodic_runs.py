"""Periodic runs in the word sequences of texts, found on a grammar instead of the text.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal)
that no neighbouring word extends keeping the period and that holds at least ``MIN_WORDS`` words and
``MIN_PERIODS`` periods. Word sequences are compressed by Re-Pair: rounds replace, in order of
frequency, repeated pairs of symbols by a new symbol, a rule, until no pair of a text repeats. A run
lies across the boundary of some rule's two halves, or of two symbols of what remains of the text.
Runs across the boundary of a rule are worked out once for the rule, within its own expansion, and
then translated to every place that the rule derives; what a rule's ends cut short is merged into
the maximal run, which crosses a higher boundary.

Candidates at a boundary: let ``q`` be a period with ``G/2 < q <= G``, ``G`` a power of two. A run
of four periods holds the ``G`` words in front of the boundary, or those behind it, and holds
them again ``q`` words further on or back; their nearest repetition there is exactly ``q`` away, as
a nearer one would give the run a smaller period (Fine and Wilf). So each boundary has at most four
candidates for each ``G``; how far they reach is found by comparing names of stretches of ``2**k``
words, longest first. Equal stretches have equal names, so nothing here depends on hashes.

Memory and work of a slice of texts are in proportion to its words, times the logarithm of its longest
repeated stretch.

Defined results: words are runs without ASCII white space; a null, empty or wordless text has no
words, no runs and an empty collapsed text; texts of any length are read whole; repeated rows get
equal results; two runs with different periods may overlap and are both reported; an empty table
gives an empty table. Other columns are left alone.
"""

from __future__ import annotations

from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.llm import common

#: A run has so many words, and so many times its period, at least.
MIN_WORDS = 6
MIN_PERIODS = 4
RUN = {"start": common.LONG, "length": common.LONG, "period": common.LONG}
FIELDS = common.struct(n_words=common.LONG, runs=common.span(**RUN), best=common.struct(**RUN), collapsed=common.TEXT)


class Grams(NamedTuple):
    """Of the ``2**k`` words from each place on: their name (-1 if they occur once), and how far
    it is to where they occur next and last (0: nowhere)."""

    names: np.ndarray
    ahead: np.ndarray
    behind: np.ndarray


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in order of their keys, the number of each one's group in that order, sizes of groups."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    group = np.zeros(len(keys), np.int64)
    np.cumsum(ranked[1:] != ranked[:-1], out=group[1:])
    return order, group, np.bincount(group)


def name_grams(words: np.ndarray) -> list[Grams]:
    """``Grams`` for k = 0, 1, ... as long as some stretch repeats. Words are numbers from 0 on."""
    levels: list[Grams] = []
    at, keys, size = np.arange(len(words)), words, 1
    while len(at):
        order, group, sizes = grouped(keys)
        many = sizes > 1
        if not many.any():
            break
        name, ahead, behind = np.full(len(words), -1), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        places = at[order]
        name[places] = np.where(many, np.cumsum(many) - 1, -1)[group]
        same = np.flatnonzero(group[1:] == group[:-1])
        gap = places[same + 1] - places[same]
        ahead[places[same]] = gap
        behind[places[same + 1]] = gap
        levels.append(Grams(name, ahead, behind))
        at = np.flatnonzero((name[:-size] >= 0) & (name[size:] >= 0))
        keys = name[at] * (int(many.sum()) + 1) + name[at + size]
        size *= 2
    return levels


class Grammar(NamedTuple):
    """What remains of the words (``top`` symbols, each from ``at`` on) and the rules in the order
    they were made: halves, size in words, a place they derive, and the round that made them.
    Symbols below ``words`` are words; rule ``r`` is symbol ``words + r``."""

    top: np.ndarray
    at: np.ndarray
    words: int
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    place: np.ndarray
    round: np.ndarray


def re_pair(words: np.ndarray) -> Grammar:
    """Replace repeated pairs, the most frequent first, until none is left.

    A round replaces every pair that outranks the pairs overlapping it, by frequency and, among
    equals, by a hash of the pair. A pair found to be the only one of its kind remains so.
    """
    seq, at = words.astype(np.int64), np.arange(len(words))
    number = int(words.max()) + 1 if len(words) else 0
    terminals, size = number, np.ones(number, np.int64)
    rules: list[tuple[np.ndarray, ...]] = []
    open_ = np.ones(max(len(seq) - 1, 0), bool)  # pairs that may be repeated, by their first symbol
    while True:
        here = np.flatnonzero(open_)
        if not len(here):
            break
        keys = seq[here] * number + seq[here + 1]
        order, group, counts = grouped(keys)
        kind = np.empty(len(here), np.int64)
        kind[order] = group
        repeated = counts > 1
        if not repeated.any():
            break
        first = order[np.flatnonzero(np.diff(group, prepend=-1))]
        mixed = keys[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((mixed, counts))] = np.arange(1, len(counts) + 1)
        weight = np.zeros(len(seq) - 1, np.int64)
        weight[here] = np.where(repeated, rank, 0)[kind]
        # equal weights in a row are one pair of a symbol with itself, over and over: take every second
        starts = np.flatnonzero(np.diff(weight, prepend=-1))
        value, lengths = weight[starts], np.diff(np.append(starts, len(weight)))
        top = (value > 0) & (value > np.append(0, value[:-1])) & (value > np.append(value[1:], 0))
        chosen = common.ragged(starts[top], lengths[top])
        chosen = chosen[(chosen - np.repeat(starts[top], lengths[top])) % 2 == 0]
        made, index, symbol = np.unique(weight[chosen], return_index=True, return_inverse=True)
        samples = chosen[index]
        halves = seq[samples], seq[samples + 1]
        size = np.concatenate([size, size[halves[0]] + size[halves[1]]])
        rules.append((*halves, size[number:], at[samples], np.full(len(made), len(rules))))
        open_ = weight > 0
        open_[chosen] = True
        open_[np.maximum(chosen - 1, 0)] = True
        seq[chosen] = number + symbol
        number += len(made)
        stay = np.ones(len(seq), bool)
        stay[chosen + 1] = False
        seq, at = seq[stay], at[stay]
        open_ = np.append(open_, False)[stay][:-1]
    parts = [np.concatenate([r[i] for r in rules]) if rules else np.zeros(0, np.int64) for i in range(5)]
    return Grammar(seq, at, terminals, *parts)


def reach(levels: list[Grams], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words in front of places ``a`` and ``b``, and from there on, are equal."""
    n = len(levels[0].names)
    low, high = a.copy(), a.copy()
    gap = b - a
    for k in range(len(levels) - 1, -1, -1):
        names, step = levels[k].names, 1 << k
        inside = np.flatnonzero(high + gap + step <= n)
        own = names[high[inside]]
        high[inside[(own >= 0) & (own == names[high[inside] + gap[inside]])]] += step
        inside = np.flatnonzero(low >= step)
        own = names[low[inside] - step]
        low[inside[(own >= 0) & (own == names[low[inside] + gap[inside] - step])]] -= step
    return a - low, high - a


def across(levels: list[Grams], at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs across boundaries ``at``, within ``low`` to ``high``: boundary, start, end, period."""
    edges, anchors, periods = [], [], []
    held = [np.arange(len(at)), np.arange(len(at))]  # what repeats behind and in front of a boundary
    for k, grams in enumerate(levels):
        size = 1 << k
        for front in (0, 1):
            here = held[front]
            here = here[at[here] >= front * size]
            here = held[front] = here[grams.names[at[here] - front * size] >= 0]
            place = at[here] - front * size
            for gap, back in ((grams.ahead[place], 0), (grams.behind[place], 1)):
                fit = np.flatnonzero((2 * gap > size) & (gap <= size))
                edges.append(here[fit])
                anchors.append(place[fit] - back * gap[fit])
                periods.append(gap[fit])
    if not edges:
        return tuple(np.zeros((4, 0), np.int64))
    edge, anchor, period = map(np.concatenate, (edges, anchors, periods))
    tries, which = np.unique(np.stack([anchor, period]), axis=1, return_inverse=True)
    before, after = reach(levels, tries[0], tries[0] + tries[1])
    which = which.reshape(-1)
    start = np.maximum((tries[0] - before)[which], low[edge])
    end = np.minimum((tries[0] + after)[which] + period, high[edge])
    good = (end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * period)) & (start < at[edge]) & (at[edge] < end)
    found = np.unique(np.stack([edge[good], start[good], end[good], period[good]]), axis=1)
    return tuple(found)


def derived(grammar: Grammar, bearing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rule and place for every place that the rules marked in ``bearing`` derive."""
    none = np.zeros(grammar.words, bool)
    holds = np.concatenate([none, bearing])  # by symbol: it or what it derives is marked
    bounds = common.offsets(np.bincount(grammar.round)) if len(grammar.round) else [0]
    for low, high in zip(bounds, bounds[1:], strict=False):
        made = slice(grammar.words + low, grammar.words + high)
        holds[made] |= holds[grammar.left[low:high]] | holds[grammar.right[low:high]]
    symbol, place = grammar.top, grammar.at
    rules, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while True:
        held = np.flatnonzero(holds[symbol])
        if not len(held):
            return np.concatenate(rules), np.concatenate(places)
        rule, place = symbol[held] - grammar.words, place[held]
        marked = bearing[rule]
        rules.append(rule[marked])
        places.append(place[marked])
        width = grammar.size[rule]
        left, right = grammar.left[rule], grammar.right[rule]
        own = np.where(left < grammar.words, 1, grammar.size[np.maximum(left - grammar.words, 0)])
        assert (own < width).all()
        symbol, place = np.concatenate([left, right]), np.concatenate([place, place + own])


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals: those of one period that share a period or more are one."""
    if not len(start):
        return start, end, period
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    wide = int(end.max()) + 1
    most = np.maximum.accumulate(end + period * wide) - period * wide  # of this period so far
    fresh = np.ones(len(start), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (start[1:] > most[:-1] - period[1:])
    first = np.flatnonzero(fresh)
    return start[first], np.maximum.reduceat(end, first), period[first]


def runs_of(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of texts that lie one after the other, from ``bounds[i]``
    to ``bounds[i + 1]``; words of different texts have different numbers."""
    levels = name_grams(words)
    if not levels:
        return tuple(np.zeros((3, 0), np.int64))
    grammar = re_pair(words)
    rule = np.flatnonzero(grammar.size >= MIN_WORDS)
    left, place = grammar.left[rule], grammar.place[rule]
    half = np.where(left < grammar.words, 1, grammar.size[np.maximum(left - grammar.words, 0)])
    edge, start, end, period = across(levels, place + half, place, place + grammar.size[rule])
    owner, offset, length = rule[edge], start - place[edge], end - start
    # every place of a rule that has runs, with each of them
    firsts = common.offsets(np.bincount(owner, minlength=len(grammar.size)))
    counts = np.diff(firsts)
    rules, places = derived(grammar, counts > 0)
    each = common.ragged(firsts[rules], counts[rules])
    at = np.repeat(places, counts[rules]) + offset[each]
    inner = at, at + length[each], period[each]
    # across the symbols that remain, within their text
    text = np.searchsorted(bounds, grammar.at, "right") - 1
    own = np.flatnonzero(grammar.at > bounds[text])
    _, *outer = across(levels, grammar.at[own], bounds[text[own]], bounds[text[own] + 1])
    return merged(*(np.concatenate([i, o]) for i, o in zip(inner, outer, strict=True)))


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length in periods, then the smallest start and period; exact."""
    best = runs[0]
    for run in runs[1:]:
        more = run[1] * best[2] - best[1] * run[2]
        if more > 0 or more == 0 and (run[0], run[2]) < (best[0], best[2]):
            best = run
    return best


def describe(texts: list[str]) -> dict[str, pa.Array]:
    """``FIELDS`` of each text."""
    split = [t.encode().split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    bounds = common.offsets(counts)
    coded = pa.array(list(chain.from_iterable(split)), pa.binary()).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False) + np.repeat(np.arange(len(texts)), counts) * len(coded.dictionary)
    words = np.unique(code, return_inverse=True)[1]
    start, end, period = runs_of(words, bounds)
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    text = np.searchsorted(bounds, start, "right") - 1
    cuts = common.offsets(np.bincount(text, minlength=len(texts)))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change[:-1]) == 0
    local = start - bounds[text]
    collapsed, best = [], []
    for i, own in enumerate(split):
        low, high = int(cuts[i]), int(cuts[i + 1])
        if low == high:
            collapsed.append(b" ".join(own))
            best.append(None)
            continue
        flags = kept[bounds[i] : bounds[i + 1]].tolist()
        collapsed.append(b" ".join([w for w, stays in zip(own, flags, strict=True) if stays]))
        part = slice(low, high)
        runs = zip(local[part].tolist(), (end - start)[part].tolist(), period[part].tolist(), strict=True)
        best.append(dict(zip(RUN, best_of(list(runs)), strict=True)))
    values = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (local, end - start, period)], names=list(RUN))
    return {
        "n_words": pa.array(np.diff(bounds), pa.int64()),
        "runs": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values),
        "best": pa.array(best, pa.struct([(name, pa.int64()) for name in RUN])),
        "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
    }


def find_runs(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` and ``result`` for every row: ``n_words``, all ``runs`` by start and period (starts
    count words from 0), the ``best`` one (null without runs), and the text ``collapsed``, its words
    joined by one space without those that repeat a run's first period."""
    return common.annotate(df, lambda: describe, FIELDS, text, keep)
