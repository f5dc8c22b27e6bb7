import random
import re
from collections import Counter

import numpy as np

from corpusmill.llm import quality_rules, queries
from tests.llm import helpers


def by_definition(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)
    )


def texts():
    rng = random.Random(6)
    out = [None, "", " \n", "a b", "a b c a b c", "\x1c a\x85b c", "x\x0by\x0cz"]
    for _ in range(150):
        vocabulary = [f"w{i}" for i in range(rng.choice([2, 5, 300]))] + ["#", "é", "&&"]
        out.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t\n"]) for _ in range(rng.randint(0, 120))))
    return out


def test_counts_by_definition(spark, tmp_path):
    own = texts()
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, own))
    rows = {r.doc_id: r for r in queries.op6_quality_rules(spark, sf).collect()}
    assert len(rows) == len(own)
    for i, text in enumerate(own):
        wanted = by_definition(text)
        assert (rows[i].n_words, rows[i].word_chars, rows[i].n_symbols, rows[i].n_dup_lines, rows[i].n_repeat_words) == wanted
        assert rows[i].base_failed == (wanted[0] < 50 or 100 * wanted[4] > 50 * wanted[0])
        assert not (rows[i].kept and rows[i].base_failed)


def test_long_texts_agree():
    words = [random.Random(1).choice([b"a", b"b", b"c", b"d", b"e"]) for _ in range(60)]
    numbers = np.array([ord(w) for w in words], np.int64)
    assert quality_rules.long_repeats(words) == quality_rules.repeated_words(numbers, np.array([60]))[0]


def test_estimates_recover_a_planted_model():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.9, 0.8])
    cast = rng.random((len(good), 5)) < 0.8
    agree = rng.random((len(good), 5)) < right
    votes = np.where(cast, np.where(agree == good[:, None], 1, -1), 0)
    patterns, where, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, found, share = quality_rules.estimate(patterns, counts.astype(float))
    assert abs(share - good.mean()) < 0.03 and np.abs(found - right).max() < 0.05
    assert ((posterior[where.ravel()] > 0.5) == good).mean() > 0.95



def test_clean_texts_stay_and_junk_goes(spark):
    rng = random.Random(2)
    clean = [" ".join(rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.4 else f"word{rng.randrange(900)}x" for _ in range(120)) + "." for _ in range(80)]
    junk = [" ".join(f"W{rng.randrange(900)}ORD!!" for _ in range(120)) for _ in range(8)]
    junk += [" ".join(f"w{rng.randrange(900)}o###" for _ in range(120)) for _ in range(8)]
    rows = quality_rules.judge(helpers.documents(spark, clean + junk), keep=["doc_id"]).collect()
    kept = {r.row.doc_id for r in rows if r.kept}
    assert kept == set(range(80))
    alone = quality_rules.judge(helpers.documents(spark, clean), keep=["doc_id"]).collect()
    assert all(r.kept for r in alone)


def test_odd_tables(spark):
    judged = quality_rules.judge(helpers.odd(spark))
    assert judged.columns == ["row", "result", "base_failed", "posterior", "kept"] and judged.count() == 8
    assert quality_rules.judge(helpers.empty(spark)).count() == 0
