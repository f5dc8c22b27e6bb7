import random
import zlib

import numpy as np

from corpusmill.llm import language_id, queries
from tests.llm import helpers

WORDS = {
    "en": "the of and water house mountain through thought light with from these".split(),
    "de": "der die und nicht wasser haus gebirge durch gedanke licht schön über".split(),
    "fr": "le la les eau maison montagne travers pensée lumière où être avec".split(),
}


def text(rng, lang, n=40):
    return " ".join(rng.choices(WORDS[lang], k=n))


def corpus(spark, rng, size=120):
    langs = [rng.choice(list(WORDS)) for _ in range(size)]
    return [text(rng, lang) for lang in langs], langs


def test_held_out_accuracy(spark, tmp_path):
    rng = random.Random(1)
    own, langs = corpus(spark, rng)
    wrong = [("zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, lang in enumerate(langs)]
    own += ["", "12 34 !", None]
    wrong += ["en", "de", "fr"]
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, own, wrong))
    rows = {r.doc_id: r for r in queries.op7_language_id(spark, sf).collect()}
    assert len(rows) == len(own)
    for i, lang in enumerate(langs):
        assert rows[i].lang_pred == lang  # held-out rows have a label that must not be learned
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= rows[i].score <= 1
    assert [rows[120 + i].lang_pred for i in range(3)] == ["und"] * 3


def test_grams_by_definition():
    texts = ["ab", "", "a1b é", "x"]
    codes, counts = language_id.grams_of(texts)
    wanted = []
    for t in texts:
        raw = b" " + bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in t.lower().encode()) + b" "
        wanted.append([raw[i : i + 4] for i in range(len(raw) - 3) if raw[i : i + 4] != b"    "])
    assert counts.tolist() == [len(w) for w in wanted]
    assert [int(c).to_bytes(4, "big") for c in codes] == [g for w in wanted for g in w]


def test_filters_hold_all_members_and_correct_for_false_positives():
    rng = np.random.default_rng(1)
    grams = {f"l{i}": rng.integers(0, 2**32, 3000, dtype=np.uint32) for i in range(70)}
    filters = language_id.Filters(grams)
    assert len(filters.groups) == 2
    for bit, (name, own) in enumerate(sorted(grams.items())):
        masks, _ = filters.groups[bit // 64]
        found = np.bitwise_and.reduce([masks[s] for s in language_id.slots_of(own, filters.bits)])
        assert ((found >> np.uint64(bit % 64)) & np.uint64(1)).all(), name


def test_same_counts_in_any_partitioning(spark):
    own, langs = corpus(spark, random.Random(2), 30)
    df = helpers.documents(spark, own, langs)
    one = sorted(map(tuple, language_id.count_grams(df.coalesce(1), "text", "lang").collect()))
    assert sorted(map(tuple, language_id.count_grams(df.repartition(5), "text", "lang").collect())) == one


def test_odd_tables(spark):
    filters = language_id.learn(helpers.odd(spark))
    assert set(filters.langs) <= {"en", "de", "fr"}
    found = language_id.identify(helpers.odd(spark), filters)
    rows = {r.row.doc_id: r.result for r in found.collect()}
    assert found.columns == ["row", "result"] and rows[0].lang == rows[1].lang == rows[4].lang == "und"
    nothing = language_id.learn(helpers.empty(spark))
    assert {r.result.lang for r in language_id.identify(helpers.odd(spark), nothing).collect()} == {"und"}
    assert language_id.identify(helpers.empty(spark), filters).count() == 0
