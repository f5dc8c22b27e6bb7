import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import common, decontaminate


@pytest.fixture
def session(spark):
    """A session of its own, with what it sets itself."""
    return spark.newSession()


def large(session, n=2000, size=20_000):
    """``n`` texts of ``size`` characters in one partition."""
    return session.range(n, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a b "), size // 4).alias("text"))


FIELDS = common.struct(together=common.LONG)


def together():
    def compute(texts):
        return {"together": pa.array([sum(map(len, texts))] * len(texts), pa.int64())}

    return compute


def test_rows_come_in_batches_of_bounded_size(session, monkeypatch):
    monkeypatch.setattr(common, "slices", lambda batches, *_: iter(batches))  # as Spark hands them on
    rows = common.annotate(large(session), together, FIELDS, keep=["doc_id"]).select("row.doc_id", "result.together").collect()
    assert [r.doc_id for r in rows] == list(range(2000))
    assert max(r.together for r in rows) < 1.1 * common.SLICE_BYTES


def test_a_size_that_the_session_names_stays(session):
    session.conf.set(common.BATCH_CONF, "1m")
    common.annotate(large(session), together, FIELDS)
    assert session.conf.get(common.BATCH_CONF) == "1m"


def test_rows_of_leaks_are_bounded_too(session):
    items = session.createDataFrame([(0, "a few words of an item here")], "item_id bigint, text string")
    decontaminate.find_leaks(large(session), items)
    assert session.conf.get(common.BATCH_CONF) == str(common.SLICE_BYTES)
