"""Token counting: a built-in pattern tokenizer, a BPE vocabulary, or a user function."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

TOKEN_PATTERN = r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]"

#: How byte-level vocabularies cut a text before they merge.
BPE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class BpeFile:
    """A BPE vocabulary on storage: a line for each token, its bytes in base64 and its rank.

    Spark reads the file once for each expression, on any storage it can reach; what is made of it is
    broadcast (its size is the vocabulary's), so a worker process builds it once for all its tasks.
    """

    path: str
    pattern: str = BPE_PATTERN

    def ranks(self, spark: SparkSession) -> dict[bytes, int]:
        rows = spark.read.format("binaryFile").load(self.path).select("content").take(2)
        if len(rows) != 1:
            raise ValueError(f"{self.path!r} is not one file")
        ranks: dict[bytes, int] = {}
        for number, line in enumerate(bytes(rows[0].content).splitlines(), 1):
            if not line.strip():
                continue
            try:
                token, rank = line.split()
                ranks[base64.b64decode(token, validate=True)] = int(rank)
            except ValueError as error:
                raise ValueError(f"line {number} of {self.path!r} is not a token and its rank") from error
        missing = 256 - sum(bytes([b]) in ranks for b in range(256))
        if missing:
            raise ValueError(f"{self.path!r} lacks {missing} single bytes, so some texts could not be cut")
        return ranks

    def encoding(self, spark: SparkSession):
        import tiktoken

        return tiktoken.Encoding(self.path, pat_str=self.pattern, mergeable_ranks=self.ranks(spark), special_tokens={})


#: ``regex``, a ``BpeFile``, the name of a vocabulary, an encoding of ``tiktoken``, or a function over batches.
Tokenizer = str | Callable[[Iterator[pd.Series]], Iterator[pd.Series]] | object


def _encoding(name: str):
    import tiktoken

    try:
        return tiktoken.get_encoding(name)
    except Exception as error:
        raise RuntimeError(
            f"vocabulary {name!r} is not available; point TIKTOKEN_CACHE_DIR at a copy"
        ) from error


def _with_nulls(function, batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``function`` over the texts that are there; a null text has a null count."""
    there: deque[pd.Series] = deque()

    def texts() -> Iterator[pd.Series]:
        for batch in batches:
            there.append(batch.notna())
            yield batch[there[-1]].reset_index(drop=True)

    for counts in function(texts()):
        known = there.popleft()
        whole = pd.Series(pd.NA, index=range(len(known)), dtype="Int64")
        whole[known.to_numpy()] = counts.to_numpy()
        yield whole


def _file_counter(vocabulary: BpeFile):
    spark = SparkSession.active()
    shared = spark.sparkContext.broadcast(vocabulary.encoding(spark))

    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = shared.value
        for batch in batches:
            yield pd.Series([len(ids) for ids in encoding.encode_ordinary_batch(batch.tolist(), num_threads=1)], dtype="int64")

    return _user_counter(encoded)


def _bpe_counter(name: str | object):
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = _encoding(name) if isinstance(name, str) else name
        for batch in batches:
            found = encoding.encode_batch(batch.tolist(), num_threads=1, disallowed_special=())
            yield pd.Series([len(ids) for ids in found], dtype="int64")

    return _user_counter(encoded)


def _user_counter(function):
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _with_nulls(function, batches)

    return count


def count_tokens(text: Column, tokenizer: Tokenizer = "regex") -> Column:
    """Number of tokens in ``text``; null for a null text.

    ``regex`` stays inside the JVM (about 25 MB a second and core; Arrow's own pattern counter in a
    task did 16); a ``BpeFile`` is read from storage, any other string names a BPE vocabulary of
    ``tiktoken``, and an encoding object is taken as it is; a callable maps batches of texts to batches of counts and is never given a null.
    A tokenizer in Python sees every row that reaches it, so make texts that must not be tokenized
    null first.
    """
    if isinstance(tokenizer, BpeFile):
        return _file_counter(tokenizer)(text)
    if callable(tokenizer):
        return _user_counter(tokenizer)(text)
    if isinstance(tokenizer, str) and tokenizer == "regex":
        return F.regexp_count(text, F.lit(TOKEN_PATTERN)).cast("long")
    return _bpe_counter(tokenizer)(text)
