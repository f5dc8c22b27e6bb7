import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import queries, warc
from tests.compare import compare
from tests.llm import helpers

PAGES = [
    (1, "http://a/1", "x" * 200_000),
    (2, "http://b\r\n/2", "x" * 200_000),
    (3, None, None),
    (4, "http://a/4", ""),
    (5, "http://a/5", "héé\r\n\r\nWARC/1.1\r\n"),
    (9, "http://c/9", "x" * 200_000),
    (7, "http://c/7", "héé\r\n\r\nWARC/1.1\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(3)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("packed", [True, False])
def test_round_trip(spark, pages, packed):
    folder = staging.new_path(spark, "warc-test")
    warc.write_warc(pages, folder, packed=packed)
    records = warc.read_warc(spark, folder)
    rows = {int(r.id): r for r in warc.page_records(records).collect()}
    first = {}
    for page, _, html in sorted(PAGES):
        first.setdefault(html or "", page)
    for page, _, html in PAGES:
        r = rows[page]
        assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), digest(html))
        assert r.record_type == ("response" if first[html or ""] == page else "revisit")
        assert r.refers_to == (None if first[html or ""] == page else str(first[html or ""]))
    payloads = {r.record_id: bytes(r.payload) for r in records.where("record_type = 'response'").collect()}
    assert payloads[f"{warc.PREFIX}5"] == PAGES[4][2].encode() and len(payloads) == 3


@pytest.mark.parametrize("packed", [True, False])
def test_predicates(spark, pages, packed):
    folder = staging.new_path(spark, "warc-test")
    warc.write_warc(pages, folder, packed=packed)
    records = warc.read_warc(spark, folder)
    for condition in [
        "record_type = 'revisit'",
        "target like 'http://a/%' and record_type = 'response'",
        "target is null",
        "target is not null and not target like '%4'",
        "content_length > 1000",
        "refers_to in ('urn:record:1', 'x')",
        "target > 'http://b'",
        "record_type = 'response' or target = 'http://c/9'",
        "not target = 'http://a/1'",
    ]:
        pushed = sorted(r.record_id for r in records.where(condition).collect())
        plain = sorted(r.record_id for r in spark.createDataFrame(records.collect(), records.schema).where(condition).collect())
        assert pushed == plain, condition
    assert records.count() == 7  # what was pushed before has no effect
    assert warc.read_warc(spark, folder, payload=False).where("payload is not null").count() == 0


class Counting(io.BytesIO):
    read_bytes = 0

    def read(self, size=-1):
        found = super().read(size)
        self.read_bytes += len(found)
        return found

    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("packed", [True, False])
def test_unwanted_payloads_are_not_read(packed):
    import random

    noise = random.Random(1).randbytes(3_000_000)
    parts = []
    for i in range(4):
        head, block = warc.record(str(i), f"http://h/{i}", noise, None)
        whole = head + block + warc.PLAIN_END
        parts.append(warc.gzip_member(whole) if packed else whole)
    wanted = [warc.EqualTo(("target",), "http://h/2")]
    file = Counting(b"".join(parts))
    rows = list(warc.records(file, packed, wanted, True))
    assert [r["payload"] for r in rows] == [noise] and file.read_bytes < 4_000_000
    file = Counting(b"".join(parts))
    assert len(list(warc.records(file, packed, [], False))) == 4 and file.read_bytes < 700_000


def test_foreign_files():
    head, block = warc.record("a", "t", b"hello", None)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nX: a\r\n b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    joined = info + head + block + warc.PLAIN_END
    for data, packed in [(joined, False), (gzip.compress(info) + gzip.compress(head + block + warc.PLAIN_END), True)]:
        rows = list(warc.records(Counting(data), packed, [], True))
        assert [(r["record_type"], bytes(r["payload"])) for r in rows] == [("warcinfo", b"abc"), ("response", b"hello")]
    for data, packed in [(joined[:-30], False), (gzip.compress(joined)[:-12], True)]:
        with pytest.raises(EOFError):
            list(warc.records(Counting(data), packed, [], True))
    assert gzip.decompress(warc.gzip_member(b"abc")) == b"abc"


def test_partitions(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BYTES_PER_PARTITION", 100)
    for i, size in enumerate([10, 250, 60, 30, 5]):
        (tmp_path / f"f{i}.warc").write_bytes(b"x" * size)
    (tmp_path / ".hidden.warc").write_bytes(b"x")
    found = [[p.rsplit("/", 1)[1] for p in part.paths] for part in warc.WarcReader(f"file://{tmp_path}", True).partitions()]
    assert found == [["f1.warc"], ["f2.warc", "f3.warc", "f0.warc"], ["f4.warc"]]


def test_empty_and_odd_tables(spark, pages):
    folder = staging.new_path(spark, "warc-test")
    warc.write_warc(pages.limit(0), folder)
    assert warc.read_warc(spark, folder).count() == 0
    assert warc.read_warc(spark, staging.new_path(spark, "missing")).count() == 0
    folder = staging.new_path(spark, "warc-test")
    odd = helpers.odd(spark)
    warc.write_warc(odd, folder, id="doc_id", target="source", payload="text")
    rows = warc.page_records(warc.read_warc(spark, folder)).collect()
    assert len(rows) == 8 and sum(r.record_type == "response" for r in rows) == 7  # null and empty are equal


def test_query_against_sql(spark, tmp_path, pages):
    names = "region nation customer supplier part orders lineitem events documents embeddings benchmark labels conversations".split()
    small = spark.range(1).select(F.col("id"))
    pages.coalesce(1).write.parquet(f"{tmp_path}/made")
    import shutil
    from pathlib import Path

    shutil.copy(next(Path(f"{tmp_path}/made").glob("part-*.parquet")), f"{tmp_path}/pages.parquet")
    small.toPandas().to_parquet(f"{tmp_path}/one.parquet")
    for name in names:
        shutil.copy(f"{tmp_path}/one.parquet", f"{tmp_path}/{name}.parquet")
    count, problem = compare(spark, str(tmp_path), queries.op4_warc, queries.ORACLE["op4_warc"])
    assert problem is None, problem
    assert count == len(PAGES)
