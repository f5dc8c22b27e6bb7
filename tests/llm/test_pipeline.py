import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from corpusmill.llm import decontaminate, piece_codec, queries, secret_scan
from tests.llm import helpers

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


def test_registered():
    found = entry.queries()
    assert "pipeline" in found
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage took and returned over a whole table."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        made = spark.read.parquet(f"{folder}/{name}")
        out.append((name, {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in made.collect()}))
        docs = made
    return out


def test_stages_keep_the_columns(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for _, _, made in stages[:-1]:
        assert list(next(iter(made.values())).asDict()) == columns


def test_each_stage_on_its_input(spark, stages):
    by_name = {name: (took, made) for name, took, made in stages}
    took, made = by_name["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    known = [d for d in took if d in labels]
    assert sum((d in made) == bool(labels[d]) for d in known) >= 0.95 * len(known)
    took, made = by_name["near_copies"]
    assert {r.text for r in made.values()} == {r.text for r in took.values() if r.doc_id in made}
    seen = {}
    for d in sorted(took):
        seen.setdefault(took[d].text, d)
    assert all(d in seen.values() for d in made)
    took, made = by_name["decontaminate"]
    block = decontaminate.prepare([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    leaks = decontaminate.leaks_of(block, [took[d].text for d in took], decontaminate.THRESHOLD)
    assert set(made) == {d for d, found in zip(took, leaks, strict=True) if not found}
    took, made = by_name["secrets"]
    assert set(took) == set(made)
    for d, row in made.items():
        assert secret_scan.spans_of(row.text)[0] == [] and (row.text == took[d].text) == (not any(secret_scan.spans_of(took[d].text)))
    took, made = by_name["encode"]
    codec = piece_codec.load(piece_codec.read_model(spark, queries.TOKENIZER))
    import numpy as np

    ids = [made[d].ids for d in took]
    ends = np.cumsum([0, *map(len, ids)])
    assert piece_codec.decode_ids(np.array([i for x in ids for i in x]), ends, codec) == [took[d].text for d in took]


def test_run_equals_the_stages(spark, stages):
    got = {r.doc_id: (r.n_tokens, len(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {d: (r.n_tokens, len(r.ids)) for d, r in stages[-1][2].items()}


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    known = spark.createDataFrame([(3, 1, 0)], "doc_id bigint, quality bigint, toxic bigint")
    items = spark.createDataFrame([(0, "a few words of a benchmark item here")], "item_id bigint, text string")
    sf = helpers.tables(spark, tmp_path, labels=known, benchmark=items)
    for docs, least in ((helpers.odd(spark), 1), (helpers.empty(spark), 0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf).count() >= least
