"""Secret scan by dictionary-primed zstandard novelty.

Three patterns give the base spans. The method adds strings that stand near a sensitive word, at
most ``REACH`` characters behind or in front of it, and that zstandard cannot shorten although it is
primed with common identifiers and with the text around them (other copies of the string taken out):
their marginal compressed size is close to their length. Candidates are runs of at least 16 of the
characters of encoded keys, and of at least 16 printable ASCII characters without quotes, brackets
and ``,;:=``; sensitive words part them. No class of characters is asked for.

Defined results: a null or empty text has no spans; text of any length is scanned whole; spans are
in code points with an exclusive end, ordered by start, then by kind as in ``KINDS``; repeated
rows give repeated results; an empty table gives an empty table. Other columns are left alone.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import common
from corpusmill.llm.common import LONG, TEXT

KINDS = ["assign", "access", "hex", "novel"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: What every text with an assignment contains in lower case.
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]

SENSITIVE = re.compile(
    r"password|passwd|passphrase|secret|token|credential|bearer|authorization|(?:api|access|private|signing|encryption)[_\x20-]?key",
    re.I | re.A,
)
SENSITIVE_WORDS = [*ASSIGN_WORDS, "passphrase", "credential", "bearer", "authorization", "key"]
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Runs with symbols; of these, ``EDGES`` are punctuation at the end of a run.
BROKEN = re.compile(r"""[^\s"'`<>(){}\[\],;:=\x00-\x20\x7f-\U0010ffff]{16,}""")
EDGES = ".!?"
LEAST = 16
#: How far from a sensitive word a candidate starts or ends at most, how much text on either side of it
#: primes the frame (what is further away says little of what to expect), and the share of its length
#: that a candidate adds at least: scan_secrets takes all three as arguments.
REACH = 48
AROUND = 1024
RATIO = 0.7
IDENTIFIERS = (
    "access account action address admin algorithm api app application argument array async attribute auth await "
    "base64 boolean buffer build bucket byte cache callback certificate char class client cloud code command "
    "config connection const container content context cookie count create credential data database date debug "
    "default define delete dev directory disable document domain email enable encoding endpoint engine env "
    "environment error event example exception export false file filter final format function generate get group "
    "handler hash header host html http https id identifier import index info input instance int integer "
    "interface internal item java javascript json key label language length level library license list local "
    "localhost log login main manager map master message method model module name namespace network node null "
    "number object option order output package page param parameter parse password path pattern placeholder port "
    "private process production profile project property protocol provider proxy public python query read "
    "reference region register release remote request resource response result return role root route sample "
    "schema script search secret security select sequence server service session set setting sha256 shared "
    "signature size source staging start state static status storage string structure subscription system table "
    "target task template tenant test text thread time timestamp title token true type undefined update upload "
    "url user username utf8 uuid value variable vector version view virtual void volume webhook window worker "
    "workspace write xml yaml your_api_key_here changeme 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ ----------------================________________"
)

FIELDS = common.struct(
    n_assign=LONG,
    n_access=LONG,
    n_hex=LONG,
    n_novel=LONG,
    base_spans=TEXT,
    spans=common.span(kind=TEXT, start=LONG, end=LONG),
)


def base_spans(text: str, lowered: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the three patterns, in order."""
    found = []
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def marginal_bytes(candidate: str, around: str, identifiers: str = IDENTIFIERS, level: int = 3) -> int:
    """Compressed bytes that ``candidate`` adds to a frame primed with identifiers and surroundings.

    Both go in front of it in the same frame: zstandard stores so short an input raw when only a
    separate dictionary is set.
    """
    primed = f"{identifiers} {around.replace(candidate, ' ')} ".encode()
    packer = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)
    return len(packer.compress(primed + candidate.encode())) - len(packer.compress(primed))


def pieces(run: re.Match, words: list[tuple[int, int]], starts: list[int]) -> list[tuple[int, int]]:
    """What sensitive words leave of a run, if long enough."""
    at, out = run.start(), []
    for start, end in words[max(bisect_left(starts, at) - 1, 0) : bisect_left(starts, run.end())]:
        if end > at:
            out.append((at, start))
            at = end
    return [(a, b) for a, b in [*out, (at, run.end())] if b - a >= LEAST]


def candidates(text: str, reach: int = REACH) -> list[tuple[int, int]]:
    """Places of strings that start or end at most ``reach`` characters from a sensitive word, longer
    ones before those within them."""
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    found = set()
    for run in CANDIDATE.finditer(text):
        found.update(pieces(run, words, starts))
    for run in BROKEN.finditer(text):
        for start, end in pieces(run, words, starts):
            end = start + len(text[start:end].rstrip(EDGES))
            if end - start >= LEAST:
                found.add((start, end))

    def near(start: int, end: int) -> bool:
        behind, front = bisect_right(ends, start) - 1, bisect_left(starts, end)
        return behind >= 0 and start - ends[behind] <= reach or front < len(starts) and starts[front] - end <= reach

    return sorted((c for c in found if near(*c)), key=lambda c: (c[0], -c[1]))


def novel_spans(
    text: str, lowered: str, base: list[tuple[int, int, int]], reach: int = REACH, around: int = AROUND, ratio: float = RATIO
) -> list[tuple[int, int, int]]:
    """Incompressible strings near a sensitive word, outside base spans; none within another."""
    if not any(word in lowered for word in SENSITIVE_WORDS):
        return []
    found, done = [], 0
    for start, end in candidates(text, reach):
        if end <= done or any(s <= start and end <= e for s, _, e in base):
            continue
        value = text[start:end]
        near = text[max(0, start - around) : start] + " " + text[end : end + around]
        if marginal_bytes(value, near) >= ratio * len(value):
            found.append((start, 3, end))
            done = end
    return found


def spans_of(
    text: str, reach: int = REACH, around: int = AROUND, ratio: float = RATIO
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and the method's spans of one text."""
    lowered = text.lower()
    base = base_spans(text, lowered)
    return base, novel_spans(text, lowered, base, reach, around, ratio)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _start(reach: int, around: int, ratio: float):
    def compute(texts: list[str]) -> dict[str, pa.Array]:
        counts, base_text, all_spans = [], [], []
        for text in texts:
            base, novel = spans_of(text, reach, around, ratio)
            counts.append([sum(kind == k for _, kind, _ in base) for k in range(3)] + [len(novel)])
            base_text.append(written(base))
            spans = sorted(base + novel)
            all_spans.append([{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in spans])
        names = ["n_assign", "n_access", "n_hex", "n_novel"]
        out = {n: pa.array([c[i] for c in counts], pa.int64()) for i, n in enumerate(names)}
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return out | {"base_spans": pa.array(base_text, pa.string()), "spans": pa.array(all_spans, pa.list_(span))}

    return compute


def scan_secrets(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    reach: int = REACH,
    around: int = AROUND,
    ratio: float = RATIO,
) -> DataFrame:
    """``row`` and ``result`` (``FIELDS``): counts of each kind, base spans as text, and all spans."""
    return common.annotate(df, lambda: _start(reach, around, ratio), FIELDS, text, keep)


def redacted(text: str, mark: str) -> str:
    """``text`` with every stretch that a span covers replaced by ``mark``."""
    base, novel = spans_of(text)
    out, at = [], 0
    for start, _, end in sorted(base + novel):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(df: DataFrame, text: str = "text", length: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, secrets replaced by ``mark``; ``length``, if there, holds the new
    number of code points of changed texts. A null text stays null."""

    def start():
        def compute(texts: list[str]) -> dict[str, pa.Array]:
            return {"text": pa.array([redacted(t, mark) for t in texts], pa.string())}

        return compute

    clean = common.annotate(df, start, common.struct(text=TEXT), text)
    old, new = F.col("row").getField(text), F.col("result.text")
    columns = []
    for field in df.schema.fields:
        value = F.col("row").getField(field.name)
        if field.name == text:
            value = F.when(old.isNotNull(), new)
        elif field.name == length:
            value = F.when(old.isNull() | (old == new), value).otherwise(F.char_length(new).cast(field.dataType))
        columns.append(value.alias(field.name))
    return clean.select(*columns)
