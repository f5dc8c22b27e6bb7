"""SentencePiece encoding and decoding.

Encoding is the Unigram Viterbi search: the best sum of log scores over all ways to cut a text into
pieces, found in a double-array trie over the pieces' UTF-8 bytes. A character that is no piece
costs the lowest score less ``UNKNOWN_PENALTY`` and falls back to its byte pieces (or to the unknown
piece, if the model has none). Of equal sums the one whose last piece is longest wins. Spaces become
the white-space marker, and a marker is put in front if the model says so; decoding undoes both and
joins byte pieces.

A piece of the supported models has markers at its start only, so the best cut of a text is the
best cut of its chunks (markers with the characters up to the next marker; line ends apart if no
piece holds one). Chunks are searched many at a time with array operations, long ones alone; each
task remembers chunks it has met. A model whose pieces cross white space is searched text by text.

Defined results: a null or empty text has no tokens and decodes to an empty text; the round trip is
exact for every text without the marker character itself (it decodes to a space) and without
characters the model cannot express; texts of any length are encoded whole; repeated rows get
equal results; an empty table gives an empty table. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm import common

MARK = "▁"
UNKNOWN_PENALTY = 10.0
UNKNOWN_SURFACE = " ⁇ ".encode()
TOGETHER = 64  # chunks of at most so many bytes are searched together
REMEMBERED = 300_000  # chunks a task remembers
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5


class Trie(NamedTuple):
    """Double array: the child of ``s`` by byte ``c`` is ``base[s] + c`` if ``check`` of it is ``s``."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    longest: int


class Codec(NamedTuple):
    """What tasks need of a model."""

    trie: Trie
    scores: np.ndarray
    unknown: int
    unknown_score: float
    bytes_at: np.ndarray  # piece of each byte, -1 without byte fallback
    surface: np.ndarray  # bytes of all pieces, decoded, one after the other
    surface_at: np.ndarray
    dummy_prefix: bool
    squeeze: bool
    chunk: str  # pattern that cuts a text into chunks


def build_trie(pieces: list[tuple[bytes, int]]) -> Trie:
    """Double-array trie of ``(bytes, value)``: large families of children get their place first,
    each in the first window that has one, single children fill the gaps."""
    children: list[dict[int, int]] = [{}]
    values = [-1]
    for raw, value in pieces:
        node = 0
        for c in raw:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                values.append(-1)
            node = children[node][c]
        values[node] = value
    window = 4096
    taken = np.zeros(2 * len(children) + 4 * window, bool)
    taken[0] = True
    starts = [0] * len(children)
    front, free = 1, 0
    for node in sorted((n for n, family in enumerate(children) if family), key=lambda n: -len(children[n])):
        codes = np.array(sorted(children[node]))
        if len(codes) == 1:
            while taken[free] or free <= codes[0]:
                free += 1
            start = free - codes[0]
        else:
            low = front
            while True:
                if low + window + 256 > len(taken):
                    taken = np.concatenate([taken, np.zeros(len(taken), bool)])
                fits = ~taken[low + codes[0] : low + codes[0] + window]
                for c in codes[1:]:
                    fits &= ~taken[low + c : low + c + window]
                if fits.any():
                    break
                low += window
                front = low if len(codes) == 2 else front
            start = low + int(fits.argmax())
        if start + 512 > len(taken):
            taken = np.concatenate([taken, np.zeros(len(taken), bool)])
        taken[start + codes] = True
        starts[node] = int(start)
    size = len(taken) + 257  # so that a place plus a byte never leaves the arrays
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    queue = [(0, 0)]
    for node, place in queue:
        base[place], value[place] = starts[node], values[node]
        for c, child in children[node].items():
            check[starts[node] + c] = place
            queue.append((child, starts[node] + c))
    return Trie(base, check, value, max((len(raw) for raw, _ in pieces), default=0))


def read_model(spark: SparkSession, path: str) -> bytes:
    """The model file; a path with a scheme is read through Spark."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as file:
        return file.read()


def load(model: bytes) -> Codec:
    """From the bytes of a model file with the identity normalizer."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    normal = proto.normalizer_spec
    if normal.precompiled_charsmap:
        raise ValueError(f"normalizer {normal.name!r} is not supported, only identity")
    if not normal.escape_whitespaces:
        raise ValueError("models that do not mark white space are not supported")
    return codec(
        [(p.piece, p.score, p.type) for p in proto.pieces],
        dummy_prefix=normal.add_dummy_prefix,
        squeeze=normal.remove_extra_whitespaces,
        byte_fallback=proto.trainer_spec.byte_fallback,
    )


def codec(pieces: list[tuple[str, float, int]], dummy_prefix: bool, squeeze: bool, byte_fallback: bool) -> Codec:
    """From ``(piece, log score, type)`` in the order of the ids."""
    scored = [s for _, s, kind in pieces if kind == NORMAL]
    low, high = min(scored, default=0.0), max(scored, default=0.0)
    scores = np.array([s for _, s, _ in pieces], np.float64)
    bytes_at = np.full(256, -1, np.int32)
    unknown, surfaces, searched = 0, [], []
    for number, (piece, _, kind) in enumerate(pieces):
        surface = piece.replace(MARK, " ").encode()
        if kind == UNKNOWN:
            unknown, surface = number, UNKNOWN_SURFACE
        elif kind == CONTROL:
            surface = b""
        elif kind == BYTE:
            surface = bytes([int(piece[3:5], 16)])
            if byte_fallback:
                bytes_at[surface[0]] = number
        elif kind != UNUSED:
            searched.append((piece.encode(), number))
            if kind == USER_DEFINED:
                scores[number] = len(piece.encode()) * high - 0.1
        surfaces.append(surface)
    texts = [pieces[number][0] for _, number in searched]
    if any(re.search(f"[^{MARK}]{MARK}", t) for t in texts):
        chunk = r"(?s).+"
    elif any("\n" in t for t in texts):
        chunk = f"{MARK}*[^{MARK}]+|{MARK}+"
    else:
        chunk = f"{MARK}*[^{MARK}\n]+|{MARK}+|\n"
    return Codec(
        build_trie(searched),
        scores,
        unknown,
        low - UNKNOWN_PENALTY,
        bytes_at,
        np.frombuffer(b"".join(surfaces), np.uint8),
        common.offsets(np.array([len(s) for s in surfaces], np.int64)),
        dummy_prefix,
        squeeze,
        chunk,
    )


def prepared(text: str, c: Codec) -> str:
    """``text`` with markers for spaces."""
    if c.squeeze:
        text = re.sub(" +", " ", text.strip(" "))
    if text and c.dummy_prefix:
        text = " " + text
    return text.replace(" ", MARK)


def width(lead: int) -> int:
    """Bytes of the UTF-8 character that starts with ``lead``."""
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


WIDTHS = np.array([width(b) for b in range(256)], np.int64)


def search_one(raw: bytes, c: Codec, lists: tuple[list, list, list, list]) -> list[int]:
    """Ids of one chunk; the forward search keeps one best cut per byte."""
    base, check, value, scores = lists
    n = len(raw)
    best, came, via = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    at = 0
    while at < n:
        here, state, end, size = best[at], 0, at, width(raw[at])
        single = False
        while end < n:
            child = base[state] + raw[end]
            if check[child] != state:
                break
            state, end = child, end + 1
            piece = value[state]
            if piece >= 0:
                single |= end - at == size
                if here + scores[piece] > best[end]:
                    best[end], came[end], via[end] = here + scores[piece], at, piece
        if not single and here + c.unknown_score > best[at + size]:
            best[at + size], came[at + size], via[at + size] = here + c.unknown_score, at, -1
        at += size
    cuts, end = [], n
    while end:
        cuts.append((came[end], end, via[end]))
        end = came[end]
    ids: list[int] = []
    unknown_before = False
    for start, end, piece in reversed(cuts):
        if piece >= 0:
            ids.append(piece)
        elif c.bytes_at[raw[start]] >= 0:
            ids += [int(c.bytes_at[b]) for b in raw[start:end]]
        elif not unknown_before:
            ids.append(c.unknown)
        unknown_before = piece < 0
    return ids


def search_many(raws: list[bytes], c: Codec) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many chunks one after the other, and how many each has.

    All places of all chunks walk the trie together; the pieces found are then taken in order of
    their start, so each step extends the best cuts of all chunks at once.
    """
    lengths = np.array([len(r) for r in raws], np.int64)
    text = np.frombuffer(b"".join(raws), np.uint8).astype(np.int64)
    chunk = np.repeat(np.arange(len(raws)), lengths)
    stop = np.cumsum(lengths)
    begin = stop - lengths
    places = np.flatnonzero((text & 0xC0) != 0x80)
    found_at, found_size, found_piece = [], [], []
    place, state, end = places, np.zeros(len(places), np.int64), stop[chunk[places]]
    for step in range(c.trie.longest):
        inside = place + step < end
        place, state, end = place[inside], state[inside], end[inside]
        child = c.trie.base[state] + text[place + step]
        fits = c.trie.check[child] == state
        place, state, end = place[fits], child[fits], end[fits]
        if not len(place):
            break
        piece = c.trie.value[state]
        real = piece >= 0
        found_at.append(place[real])
        found_size.append(np.full(int(real.sum()), step + 1))
        found_piece.append(piece[real])
    at, size, piece = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (found_at, found_size, found_piece))
    single = np.zeros(len(text), bool)
    single[at[size == WIDTHS[text[at]]]] = True
    bare = places[~single[places]]
    at, size = np.concatenate([at, bare]), np.concatenate([size, WIDTHS[text[bare]]])
    piece = np.concatenate([piece, np.full(len(bare), -1)])
    local = at - begin[chunk[at]]
    order = np.argsort(local, kind="stable")
    at, size, piece, local = at[order], size[order], piece[order], local[order]
    source = at + chunk[at]  # chunk k has one place more than bytes, so its places start k later
    target = source + size
    cost = np.where(piece >= 0, c.scores[piece], c.unknown_score)
    best = np.full(len(text) + len(raws), -np.inf)
    best[begin + np.arange(len(raws))] = 0
    via = np.zeros(len(best), np.int64)
    cuts = np.searchsorted(local, np.arange(int(lengths.max(initial=0)) + 1))
    for low, high in zip(cuts, cuts[1:], strict=False):
        total = best[source[low:high]] + cost[low:high]
        better = np.flatnonzero(total > best[target[low:high]])
        best[target[low + better]] = total[better]
        via[target[low + better]] = low + better
    ids = np.full(len(text), -1, np.int64)
    here = (stop + np.arange(len(raws)))[lengths > 0]
    first = (begin + np.arange(len(raws)))[lengths > 0]
    while len(here):
        step = via[here]
        known = piece[step] >= 0
        ids[at[step[known]]] = piece[step[known]]
        lost = step[~known]
        for offset in range(4):
            byte = at[lost[size[lost] > offset]] + offset
            own = c.bytes_at[text[byte]]
            ids[byte] = np.where(own < 0, c.unknown, own) if offset == 0 else own
        here = source[step]
        left = here > first
        here, first = here[left], first[left]
    real = np.flatnonzero(ids >= 0)
    if c.bytes_at.min() < 0:  # neighbouring unknown characters make one unknown piece
        alone = np.ones(len(real), bool)
        same = (chunk[real[1:]] == chunk[real[:-1]]) & (ids[real[1:]] == c.unknown) & (ids[real[:-1]] == c.unknown)
        alone[1:] = ~same
        real = real[alone]
    return ids[real].astype(np.int32), np.bincount(chunk[real], minlength=len(raws))


class Encoder:
    """Encodes batches of texts and remembers chunks."""

    def __init__(self, c: Codec):
        self.codec = c
        self.find = re.compile(c.chunk).findall
        self.lists = (c.trie.base.tolist(), c.trie.check.tolist(), c.trie.value.tolist(), c.scores.tolist())
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def learn(self, chunks: Iterable[str]) -> None:
        """Adds the ids of new chunks to the pool."""
        raws = {c: c.encode() for c in chunks}
        long = {c: raws.pop(c) for c in [c for c, raw in raws.items() if len(raw) > TOGETHER]}
        ids, counts, short = [self.pool], [np.diff(self.ends)], list(raws.values())
        for low in range(0, len(short), 20_000):
            found, n = search_many(short[low : low + 20_000], self.codec)
            ids.append(found)
            counts.append(n)
        for raw in long.values():
            found = search_one(raw, self.codec, self.lists)
            ids.append(np.array(found, np.int32))
            counts.append(np.array([len(found)]))
        self.known.update(zip([*raws, *long], range(len(self.known), len(self.known) + len(raws) + len(long)), strict=True))
        self.pool = np.concatenate(ids)
        self.ends = common.offsets(np.concatenate(counts))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's start and end."""
        chunks, counts = [], []
        for text in texts:
            own = self.find(prepared(text, self.codec))
            chunks += own
            counts.append(len(own))
        new = set(chunks).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.forget()
            new = set(chunks)
        if new:
            self.learn(new)
        at = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        starts, lengths = self.ends[at], self.ends[at + 1] - self.ends[at]
        ids = self.pool[common.ragged(starts, lengths)]
        return ids, common.offsets(lengths)[common.offsets(np.array(counts, np.int64))]


def decode_ids(ids: np.ndarray, ends: np.ndarray, c: Codec) -> list[str]:
    """Texts of consecutive id lists that end at ``ends[1:]``."""
    lengths = np.diff(c.surface_at)[ids]
    raw = c.surface[common.ragged(c.surface_at[ids], lengths)].tobytes()
    at = common.offsets(lengths)[ends].tolist()
    out = []
    for low, high in zip(at, at[1:], strict=False):
        text = raw[low:high].decode("utf-8", "replace")
        out.append(text[1:] if c.dummy_prefix and text.startswith(" ") else text)
    return out


FIELDS = common.struct(
    ids=T.ArrayType(T.IntegerType()),
    n_tokens=common.LONG,
    n_byte_tokens=common.LONG,
    decoded_sha256=common.TEXT,
    exact=common.FLAG,
)


#: Bytes of text searched together: every place has several pieces, each in a few arrays.
SEARCH_BYTES = 1 << 20


def _start(c: Codec, verify: bool):
    encoder = Encoder(c)
    is_byte = np.zeros(len(c.scores), bool)
    is_byte[c.bytes_at[c.bytes_at >= 0]] = True

    def compute(texts: list[str]) -> dict[str, pa.Array]:
        ids, ends = encoder.encode(texts)
        fallen = common.offsets(is_byte[ids].astype(np.int64))
        digests, exact = [None] * len(texts), [None] * len(texts)
        if verify:
            decoded = decode_ids(ids, ends, c)
            digests = [hashlib.sha256(d.encode()).hexdigest() for d in decoded]
            exact = [d == t for d, t in zip(decoded, texts, strict=True)]
        return {
            "ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
            "n_tokens": pa.array(np.diff(ends)),
            "n_byte_tokens": pa.array(fallen[ends[1:]] - fallen[ends[:-1]]),
            "decoded_sha256": pa.array(digests, pa.string()),
            "exact": pa.array(exact, pa.bool_()),
        }

    return compute


def encode(
    df: DataFrame, c: Codec, text: str = "text", keep: list[str] | None = None, verify: bool = False
) -> DataFrame:
    """``row`` and ``result`` (``FIELDS``). With ``verify`` the ids are decoded again in the same
    task: the digest of the decoded text, and whether it is the text; else both are null."""
    return common.annotate(df, lambda: _start(c, verify), FIELDS, text, keep, SEARCH_BYTES)


def decode(df: DataFrame, c: Codec, ids: str = "ids") -> DataFrame:
    """``row`` (all columns) and ``result`` (``text``) of rows with a list of ids; null ids are an
    empty list, ids outside the model decode to nothing."""
    packed = df.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = np.array([len(x) for x in column], np.int64) if len(column) else np.zeros(0, np.int64)
            inside = (flat >= 0) & (flat < len(c.scores))
            kept = common.offsets(inside.astype(np.int64))
            texts = decode_ids(flat[inside], kept[common.offsets(lengths)], c)
            result = pa.StructArray.from_arrays([pa.array(texts, pa.string())], names=["text"])
            yield pa.RecordBatch.from_arrays([batch.column(0), result], names=["row", "result"])

    fields = T.StructType([T.StructField("row", df.schema), T.StructField("result", common.struct(text=common.TEXT))])
    return packed.mapInArrow(run, fields)
