import base64

import pytest
import regex
from pyspark.sql import functions as F

from corpusmill.functions import tokens
from corpusmill.operators import extract
from corpusmill.plans import q_files

TEXTS = [None, "", " ", "the the\n\n  There's 12345 items, isn't it?", "naïve 日本語 \U0001f600\x00 end", "<|endoftext|> is text", "a" * 300 + "\t\r\n" * 20]


def merged(piece, ranks):
    """Merge the pair with the lowest rank, the leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not pairs:
            return parts
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def plain_count(text, ranks, pattern=tokens.BPE_PATTERN):
    return None if text is None else sum(len(merged(p.encode(), ranks)) for p in regex.findall(pattern, text))


@pytest.fixture(scope="module")
def ranks():
    lines = open(q_files.VOCABULARY, "rb").read().split(b"\n")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}


def test_counts_by_merging(spark, ranks):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)
    found = df.select("id", tokens.count_tokens(F.col("text"), tokens.BpeFile(q_files.VOCABULARY)).alias("n")).collect()
    assert {r.id: r.n for r in found} == {i: plain_count(t, ranks) for i, t in enumerate(TEXTS)}


def test_query_over_whole_documents(spark, ranks):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {r.doc_id: r.tokens for r in q_files.bpe_token_count(spark, sf).collect()}
    assert found == {i: plain_count(t, ranks) for i, t in texts.items()}


def test_own_vocabulary_and_pattern(spark, tmp_path):
    own = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"bc": 258}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in own.items()))
    df = spark.createDataFrame([("abcabc bc",), ("xabc",)], "text string")
    counted = tokens.count_tokens(F.col("text"), tokens.BpeFile(str(path), r"\S+|\s"))
    assert [r[0] for r in df.select(counted).collect()] == [2 + 1 + 1, 2]
    content = df.select(F.lit("p").alias("project_name"), F.lit("f").alias("x"), F.col("text"))
    assert content.select(F.sum(counted)).first()[0] == 6


def test_broken_vocabularies(spark, tmp_path):
    for name, content in (("a", b"YQ== 0\n"), ("b", b"not base64! 1\n"), ("c", b"YQ==\n")):
        (tmp_path / name).write_bytes(content)
        with pytest.raises(ValueError, match="lacks 255|line 1"):
            tokens.count_tokens(F.col("text"), tokens.BpeFile(str(tmp_path / name)))
    (tmp_path / "folder").mkdir()
    with pytest.raises(ValueError, match="not one file"):
        tokens.count_tokens(F.col("text"), tokens.BpeFile(str(tmp_path / "folder")))


def test_extraction_takes_it(spark):
    files = spark.createDataFrame([("o_p", "x.py", 9, bytearray(b"x = 1 + 2"))], "dir_name string, file_path string, size long, content binary")
    counted = extract.extract_metadata(files, root="/r", tokenizer=tokens.BpeFile(q_files.VOCABULARY)).first()
    assert counted.token_count == 5
