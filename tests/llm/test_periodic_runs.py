import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from corpusmill.llm import periodic_runs, queries
from tests.llm import helpers


def plain_runs(words):
    """The definition, word for word: every stretch of equal words q apart, for every q."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                part = words[i : j + q]
                smaller = any(all(part[k] == part[k + p] for k in range(len(part) - p)) for p in range(1, q))
                if len(part) >= max(6, 4 * q) and not smaller:
                    found.append((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def listed(result):
    return [[tuple(r.values()) for r in runs] for runs in result["runs"].to_pylist()]


def sequences():
    rng = random.Random(3)
    yield from ["", " \n", "a", "a " * 5, "a " * 6, "a " * 257, "a b " * 4, "a b " * 3 + "a", "b a a a a a a a b", "x\x1cy " * 9]
    yield "a b a c " * 40 + "a b " * 9 + "c " * 30
    yield " ".join("a" if bin(i).count("1") % 2 else "b" for i in range(300))  # overlap-free
    fib = ["a", "b"]
    while len(fib[-1]) < 200:
        fib.append(fib[-1] + fib[-2])
    yield " ".join(fib[-1])
    for letters in (2, 3, 8, 400):
        for _ in range(40):
            words = []
            while len(words) < rng.randint(0, 120):
                root = [f"w{rng.randrange(letters)}" for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17]))]
                words += (root * rng.randint(1, 6))[: rng.randint(1, 70)]
            yield " ".join(words)


def test_runs_against_brute_force():
    texts = list(sequences())
    found = periodic_runs.describe(texts)
    wanted = [plain_runs(t.encode().split()) for t in texts]
    assert listed(found) == wanted and sum(map(len, wanted)) > 150
    assert found["collapsed"].to_pylist() == [
        collapse(re.findall("[^\x20\x09-\x0d]+", t), w) for t, w in zip(texts, wanted, strict=True)
    ]
    alone = [periodic_runs.describe([t]) for t in texts[:40]]
    assert [listed(a)[0] for a in alone] == wanted[:40]


def test_grammar_derives_the_words():
    rng = random.Random(5)
    for letters, n in ((1, 100), (2, 500), (50, 2000), (3000, 2000)):
        words = np.array([rng.randrange(letters) for _ in range(n)] * 2, np.int64)
        words = np.unique(words, return_inverse=True)[1]
        g = periodic_runs.re_pair(words)

        def expand(symbol, g=g):
            if symbol < g.words:
                return [symbol]
            return expand(g.left[symbol - g.words]) + expand(g.right[symbol - g.words])

        assert [w for s in g.top for w in expand(s)] == words.tolist()
        for r, (size, place) in enumerate(zip(g.size, g.place, strict=True)):
            assert expand(g.words + r) == words[place : place + size].tolist()
        pairs = list(zip(g.top.tolist(), g.top[1:].tolist(), strict=False))
        assert all(pairs.count(p) <= 1 or p[0] == p[1] for p in pairs)


def test_rules_are_worked_out_once(monkeypatch):
    """A long line that repeats is looked at in its rules, not in every copy."""
    rng = random.Random(6)
    line = " ".join([*(f"u{i}" for i in range(40)), *["x y"] * 5])
    text = " ".join(f"{line} s{rng.randrange(10**9)}" for _ in range(200))
    seen = []
    plain = periodic_runs.across
    monkeypatch.setattr(periodic_runs, "across", lambda levels, at, *a: seen.append(len(at)) or plain(levels, at, *a))
    found = periodic_runs.describe([text])
    assert listed(found)[0] == [(i * 51 + 40, 10, 2) for i in range(200)]
    assert sum(seen) < len(text.split()) / 10


def test_long_texts():
    root = [f"w{i}" for i in range(5000)]
    words = ["a", "b", *root * 5, "c"]
    found = periodic_runs.describe([" ".join(words), "one " * 300_000])
    assert listed(found) == [[(2, 25_000, 5000)], [(0, 300_000, 1)]]
    assert found["collapsed"].to_pylist() == [" ".join(["a", "b", *root, "c"]), "one"]


def changed(doc_id, text):
    """The contract's change of a tenth of the documents."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    texts = [None, "", " \t ", " lead a b a b a b a b a b", *(" ".join(rng.choice("abcd") * 2 for _ in range(rng.randint(1, 90))) for _ in range(150))]
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, texts))
    rows = queries.op13_periodic_runs(spark, sf).collect()
    assert len(rows) == len(texts)
    looped = 0
    for r in rows:
        words = changed(r.doc_id, texts[r.doc_id])
        looped += words != re.findall("[^\x20\x09-\x0d]+", texts[r.doc_id] or "")
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *best, milli)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(collapse(words, runs))
    assert looped > 5


def test_odd_tables(spark):
    found = periodic_runs.find_runs(helpers.odd(spark, ["a b " * 8])).collect()
    by_id = {r.row.doc_id: r for r in found}
    assert len(found) == 9 and by_id[0].result.n_words == 0 and by_id[0].result.runs == [] and by_id[0].result.best is None
    assert by_id[2].result.runs[0].length == 40_000 and by_id[10].result.best.period == 2 and by_id[10].row.result == "own result"
    assert periodic_runs.find_runs(helpers.empty(spark)).count() == 0
