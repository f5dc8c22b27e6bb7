import random
import re

from pyspark.sql import functions as F

from corpusmill.llm import queries, substrings
from tests.llm import helpers


def by_definition(rows):
    """Kept texts and cut places of ``(id, text)`` in order of their ids, one unit after the other."""
    seen, out = set(), {}
    for number, text in rows:
        cuts = []
        for start, end, digest in substrings.units(text or ""):
            if digest in seen:
                cuts.append((start, end))
            seen.add(digest)
        covered = {i for a, b in cuts for i in range(a, b)}
        out[number] = (text, covered)
    return out


def texts():
    rng = random.Random(4)
    sentences = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(2, 14))) + rng.choice(". ! ?".split()) for _ in range(60)]
    lines = [" ".join(rng.sample(sentences, rng.randint(1, 4))) for _ in range(40)]
    return ["\n".join(rng.choices(lines, k=rng.randint(0, 6))) for _ in range(80)] + [None, "", "\n\n"]


def test_against_brute_force(spark, tmp_path):
    own = texts()
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, own))
    rows = {r.doc_id: r for r in queries.op3_substring_dedup(spark, sf).collect()}
    assert len(rows) == len(own)
    for number, (text, covered) in by_definition(enumerate(own)).items():
        row = rows[number]
        spans = [tuple(map(int, s.split(":"))) for s in row.removed.split(",") if s]
        assert {i for a, b in spans for i in range(a, b)} == covered and row.n_removed == len(spans)
        if text is None:
            assert row.text is None
        else:
            left = "".join(c for i, c in enumerate(text) if i not in covered)
            assert row.text.replace("\n", "") == left.replace("\n", "")


def test_passages_pasted_into_lines_are_found(spark):
    rng = random.Random(1)
    passage = " ".join(" ".join(f"p{rng.randrange(10**6)}" for _ in range(11)) + "." for _ in range(6))
    own = [" ".join(f"a{rng.randrange(10**6)}" for _ in range(60)) for _ in range(5)]
    mixed = [f"{t}. {passage} {t[::-1]}." for t in own]
    rows = {r.row.doc_id: r for r in substrings.remove_repeats(helpers.documents(spark, mixed)).collect()}
    assert rows[0].kept == mixed[0]
    for i in range(1, 5):
        assert "p" not in rows[i].kept and rows[i].kept.startswith(own[i]) and own[i][::-1] in rows[i].kept


def test_units_are_normalised_and_short_ones_stay():
    assert substrings.units("One two  three FOUR five")[0][2] == substrings.units("one two three four\tfive\nx")[0][2]
    assert [u[:2] for u in substrings.units("a b c d\nyes.\n")] == [(0, 7), (0, 12), (8, 12)]
    assert [u[:2] for u in substrings.units("So. But this one is long enough.")] == [(0, 32), (3, 32)]
    assert len(substrings.units("So. But this one is long enough.", sentence_chars=1)) == 3


def test_sentences_cover_the_line():
    for line in ["", "a. b! c", "...", 'He said "no." Then left.', "3.5 is. not", "一。二。"]:
        parts = substrings.sentences(line, 7)
        assert "".join(line[a - 7 : b - 7] for a, b in parts) == line


def own_units(text):
    """Lines and paragraphs of any length and sentences of at least ten characters, as places and words."""
    whole, parts = set(), set()
    for paragraph in re.finditer(r"(?:^[^\n]*\S[^\n]*$\n?)+", text, re.M):
        whole.add((paragraph.start(), paragraph.start() + len(paragraph[0].rstrip("\n"))))
    for line in re.finditer(r"[^\n]+", text):
        whole.add(line.span())
        start = line.start()
        for end in re.finditer(r"[.!?](?=\s)|。|$", line[0]):
            parts.add((start, line.start() + end.end()))
            start = line.start() + end.end()
    keyed = [(a, b, " ".join(text[a:b].lower().split())) for a, b in sorted(whole | parts)]
    return [u for u in keyed if len(u[2].replace(" ", "")) >= (1 if u[:2] in whole else 10)]


def test_short_lines_and_unspaced_scripts_against_own_units(spark):
    rng = random.Random(9)
    lines = ["Read more here", "internationalization", "See also: maps.", "ab cd", "yes.", "", " ", "Thank you all. Good bye to all of you!"]
    lines += ["日本語の文章はここにあります。次の文章もここにあります。", "これは重複した段落です", "ภาษาไทยไม่มีช่องว่าง"]
    own = ["\n".join(rng.choices(lines, k=rng.randint(1, 7))) for _ in range(60)]
    rows = {r.row.doc_id: r for r in substrings.remove_repeats(helpers.documents(spark, own)).collect()}
    seen = set()
    for number, text in enumerate(own):
        covered = set()
        for start, end, words in own_units(text):
            if words in seen:
                covered.update(range(start, end))
            seen.add(words)
        assert {i for s in rows[number].removed for i in range(s.start, s.end)} == covered, text
    assert sum("Read more here" in r.kept for r in rows.values()) == 1


def test_copies_without_spaces_or_wrapped_short_are_removed(spark):
    copied = "吾輩は猫である名前はまだ無い"
    wrapped = "one two\nthree\nfour five\nsix\nseven"
    own = [copied, copied, f"{wrapped}\n\nown a", f"own b\n\n{wrapped}", "one two three four five six seven"]
    kept = {r.row.doc_id: r.kept for r in substrings.remove_repeats(helpers.documents(spark, own)).collect()}
    assert kept[0] == copied and kept[1] == "" and kept[2] == own[2]
    assert kept[3].strip() == "own b" and kept[4] == ""


def test_hot_line(spark):
    line = "this very line stands in each and every document of all"
    rows = substrings.remove_repeats(helpers.documents(spark, [f"{line}\nown words number {i}" for i in range(300)])).collect()
    assert sum(line in r.kept for r in rows) == 1 and all(f"number {r.row.doc_id}" in r.kept for r in rows)


def test_odd_tables(spark):
    same = "Same words here as there, again and again."
    found = substrings.remove_repeats(helpers.odd(spark, [same, f"x\n{same}\ny"]))
    rows = {r.row.doc_id: r for r in found.collect()}
    assert found.columns == ["row", "kept", "removed"] and found.count() == 10
    assert rows[3].kept == same and rows[10].kept == "" and rows[11].kept == "y"  # row 5 has a line "x"
    assert rows[0].kept is None and rows[1].kept == "" and rows[3].row.kept == "own kept"
    assert rows[2].kept == helpers.LONG
    assert substrings.remove_repeats(helpers.empty(spark)).count() == 0
    nameless = helpers.odd(spark).withColumn("doc_id", F.lit(None).cast("bigint"))
    assert substrings.remove_repeats(nameless).count() == 8
