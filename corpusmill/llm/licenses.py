"""Licence scan with a generalised suffix automaton of licence tokens.

One automaton holds all templates. A file's words run through it and give matching statistics (how
long a suffix of what was read occurs in some template, and where). Matches that cannot be
extended are chained per template, in order on both sides and with bounded gaps, and a chain that
covers enough of its template is reported with its span. Of chains over the same words the one
that covers most of its template stays.

Beside that, three fixed phrases are counted wherever their words stand in a row.

Defined results: a null or empty text has no words; words are runs of ASCII letters and digits and
of all other characters beyond ASCII, with A-Z in lower case; texts of any length are read whole;
equal chains are ordered by template name; repeated rows get equal results; an empty table gives
an empty table. Other columns are left alone.
"""

from __future__ import annotations

from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.llm import common
from corpusmill.llm.common import LONG, REAL, TEXT
from corpusmill.llm.license_templates import TEMPLATES

#: A-Z in lower case, other letters, digits and bytes beyond ASCII as they are, the rest a space.
WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32 for c in range(256)
)
PHRASES = [(b"mit license", "mit"), (b"apache license", "apache"), (b"general public license", "gpl")]
MIN_MATCH = 3
#: Words between two matches of a chain at most: more than a name, a year or an address put into a
#: template needs, fewer than another paragraph. And the share of a template that a chain covers at least.
MAX_GAP = 12
COVERED = 0.8

FIELDS = common.struct(
    n_words=LONG,
    n_base=LONG,
    first_word=LONG,
    last_word=LONG,
    base_labels=T.ArrayType(TEXT),
    spans=common.span(label=TEXT, template=TEXT, start=LONG, end=LONG, covered=REAL),
    score=REAL,
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORDS).split()


class Automaton:
    """Generalised suffix automaton over token numbers, with the ends of each state's strings."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for number, tokens in enumerate(sequences):
            last = 0
            for at, token in enumerate(tokens):
                last = self._extend(last, token, ends)
                ends[last].add((number, at + 1))
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            ends[self.link[state]] |= ends[state]
        #: ends of strings long enough to be reported
        self.ends = [sorted(e) if n >= MIN_MATCH else [] for e, n in zip(ends, self.length, strict=True)]

    def _state(self, length: int, ends: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append(set())
        return len(self.length) - 1

    def _split(self, parent: int, token: int, state: int, ends: list) -> int:
        copy = self._state(self.length[parent] + 1, ends)
        self.next[copy] = dict(self.next[state])
        self.link[copy] = self.link[state]
        self.link[state] = copy
        while parent != -1 and self.next[parent].get(token) == state:
            self.next[parent][token] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, token: int, ends: list) -> int:
        known = self.next[last].get(token)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, token, known, ends)
        new, parent = self._state(self.length[last] + 1, ends), last
        while parent != -1 and token not in self.next[parent]:
            self.next[parent][token] = new
            parent = self.link[parent]
        if parent != -1:
            known = self.next[parent][token]
            if self.length[known] != self.length[parent] + 1:
                known = self._split(parent, token, known, ends)
            self.link[new] = known
        return new

    def matches(self, tokens: list[int]) -> list[tuple[int, int, int]]:
        """``(end, length, state)`` wherever the matching statistics reach ``MIN_MATCH``."""
        found, state, length = [], 0, 0
        for at, token in enumerate(tokens, 1):
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            if length >= MIN_MATCH:
                found.append((at, length, state))
        return found

    def occurrences(self, length: int, state: int) -> list[tuple[int, int, int]]:
        """``(template, end in it, length)`` of the longest suffix of a match in each place."""
        found, seen = [], set()
        while state > 0 and length >= MIN_MATCH:
            for place in self.ends[state]:
                if place not in seen:
                    seen.add(place)
                    found.append((*place, length))
            state = self.link[state]
            length = self.length[state]
        return found


def best_chains(
    pieces: list[tuple[int, int, int]], size: int, gap: int = MAX_GAP, least: float = COVERED
) -> list[tuple[int, int, float]]:
    """``(start, end, covered share)`` of the chains of one template, best first, not overlapping.

    ``pieces`` are ``(start in the text, start in the template, length)``.
    """
    pieces = sorted(set(pieces))
    score, back = [], []
    low = 0
    longest = max((n for _, _, n in pieces), default=0)
    for i, (at, place, n) in enumerate(pieces):
        while pieces[low][0] + longest + gap < at:
            low += 1
        best, origin = n, -1
        for j in range(low, i):
            other, before, m = pieces[j]
            overlap = max(0, other + m - at, before + m - place)
            if other < at and before < place and at - (other + m) <= gap and overlap < n and score[j] + n - overlap > best:
                best, origin = score[j] + n - overlap, j
        score.append(best)
        back.append(origin)
    taken, out = [False] * len(pieces), []
    for i in sorted(range(len(pieces)), key=lambda k: (-score[k], pieces[k])):
        if score[i] < least * size:
            break
        chain, j = [], i
        while j != -1 and not taken[j]:
            chain.append(j)
            j = back[j]
        if j != -1 or not chain:
            continue
        for j in chain:
            taken[j] = True
        out.append((pieces[chain[-1]][0], pieces[i][0] + pieces[i][2], min(1.0, score[i] / size)))
    return out


def _start(templates: list[tuple[str, str, str]], gap: int, least: float):
    numbers: dict[bytes, int] = {}
    sequences = [[numbers.setdefault(w, len(numbers)) for w in words_of(text)] for _, _, text in templates]
    automaton = Automaton(sequences)
    phrases = [(phrase.split(), label) for phrase, label in PHRASES]
    get = numbers.get

    def base(words: list[bytes]) -> list[tuple[int, str]]:
        found = []
        for phrase, label in phrases:
            at = -1
            while True:
                try:
                    at = words.index(phrase[0], at + 1)
                except ValueError:
                    break
                if words[at : at + len(phrase)] == phrase:
                    found.append((at, label))
        return found

    def templates_in(tokens: list[bytes]) -> list[dict]:
        ids = np.fromiter(map(get, tokens, repeat(-1)), np.int64, len(tokens))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids >= 0).astype(np.int8), [0]])))
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for low, high in edges.reshape(-1, 2).tolist():
            if high - low < MIN_MATCH:
                continue
            run = ids[low:high].tolist()
            for end, length, state in automaton.matches(run):
                for template, place, n in automaton.occurrences(length, state):
                    if sequences[template][place : place + 1] != run[end : end + 1] or end == len(run):
                        pieces.setdefault(template, []).append((low + end - n, place - n, n))
        out = []
        for template, own in pieces.items():
            name, label, _ = templates[template]
            for start, end, covered in best_chains(own, len(sequences[template]), gap, least):
                words = round(covered * len(sequences[template]))
                out.append({"label": label, "template": name, "start": start, "end": end, "covered": covered, "words": words})
        kept: list[dict] = []
        for span in sorted(out, key=lambda x: (-x["covered"], -x["words"], x["start"], x["template"])):
            del span["words"]
            size = span["end"] - span["start"]
            if not any(2 * (min(span["end"], k["end"]) - max(span["start"], k["start"])) > size for k in kept):
                kept.append(span)
        return sorted(kept, key=lambda x: (x["start"], x["template"]))

    def compute(texts: list[str]) -> dict[str, pa.Array]:
        rows = []
        for text in texts:
            words = words_of(text)
            places = base(words) if b"license" in words else []
            spans = templates_in(words)
            at = [p for p, _ in places]
            rows.append(
                (
                    len(words),
                    len(places),
                    min(at, default=None),
                    max(at, default=None),
                    [label for label, _ in groupby(sorted(label for _, label in places))],
                    spans,
                    max((s["covered"] for s in spans), default=0.0),
                )
            )
        span = pa.struct(
            [("label", pa.string()), ("template", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())]
        )
        types = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(span), pa.float64()]
        names = [f.name for f in FIELDS]
        return {n: pa.array([r[i] for r in rows], kind) for i, (n, kind) in enumerate(zip(names, types, strict=True))}

    return compute


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    templates: list[tuple[str, str, str]] | None = None,
    gap: int = MAX_GAP,
    covered: float = COVERED,
) -> DataFrame:
    """``row`` and ``result`` (``FIELDS``). ``templates`` are ``(name, label, text)``; matches at most ``gap``
    words apart make a chain, and chains that cover ``covered`` of their template a span."""
    chosen = TEMPLATES if templates is None else templates
    return common.annotate(df, lambda: _start(chosen, gap, covered), FIELDS, text, keep)
