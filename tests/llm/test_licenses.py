import random
import re

from corpusmill.llm import licenses, queries
from corpusmill.llm.license_templates import TEMPLATES
from tests.llm import helpers

LOWER = {c: c + 32 for c in range(65, 91)}


def by_definition(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    places = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def texts():
    rng = random.Random(3)
    parts = ["MIT", "mit", "License", "license", "Apache", "general", "public", "é", "_", "-", " ", "\n", "x1", "\x7f", "日本"]
    out = ["".join(rng.choice(parts) + rng.choice([" ", " ", "", "."]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    return [None, "", "MIT license", "mit-license", "mitlicense", *out]


def test_base_by_definition(spark, tmp_path):
    own = texts()
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, own))
    rows = {r.doc_id: r for r in queries.op10_licenses(spark, sf).collect()}
    for i, text in enumerate(own):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == by_definition(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_matching_statistics_against_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        sequences = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(3)]
        read = [rng.randrange(4) for _ in range(25)]
        automaton = licenses.Automaton(sequences)
        found = {end: (n, state) for end, n, state in automaton.matches(read)}
        for end in range(1, len(read) + 1):
            best = max(
                n for n in range(end + 1)
                if n == 0 or any(s[i : i + n] == read[end - n : end] for s in sequences for i in range(len(s) - n + 1))
            )
            assert found.get(end, (0, 0))[0] == (best if best >= licenses.MIN_MATCH else 0)
            if end in found:
                places = {(t, p): n for t, p, n in automaton.occurrences(*found[end])}
                for t, s in enumerate(sequences):
                    for p in range(1, len(s) + 1):
                        n = 0
                        while n < min(p, end) and s[p - 1 - n] == read[end - 1 - n]:
                            n += 1
                        assert places.get((t, p), 0) == (n if n >= licenses.MIN_MATCH else 0)


def spans(spark, text):
    return licenses.scan_licenses(helpers.documents(spark, [text])).first().result.spans


def test_templates_are_found_whole_and_edited(spark):
    for name, label, text in TEMPLATES:
        found = spans(spark, f"some code here {text.upper()} and more code")
        assert any(s.label == label and s.covered == 1.0 and s.start == 3 for s in found), name
    name, label, text = next(t for t in TEMPLATES if t[0] == "mit")
    words = text.split()
    words[30:32] = ["changed", "words", "here"]
    found = spans(spark, "x " * 50 + " ".join(words))
    assert [s.label for s in found] == ["mit"] and 0.9 < found[0].covered < 1
    assert spans(spark, " ".join(words[:40])) == []


def test_versions_are_told_apart(spark):
    assert [s.label for s in spans(spark, "Licensed under the GNU General Public License, version 3.")] == ["gpl-3.0"]
    assert [s.label for s in spans(spark, "Licensed under CC BY-NC 4.0")] == ["cc-by-nc-4.0"]


def test_odd_tables(spark):
    found = licenses.scan_licenses(helpers.odd(spark, ["released under the MIT license " * 3000]))
    assert found.columns == ["row", "result"] and found.count() == 9
    assert found.where("row.doc_id = 10").first().result.n_base == 3000
    assert licenses.scan_licenses(helpers.odd(spark), templates=[]).where("size(result.spans) > 0").count() == 0
    assert licenses.scan_licenses(helpers.empty(spark)).count() == 0
