import random
from pathlib import PurePath

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import html as H
from corpusmill.functions import paths, text, tokens, units
from corpusmill.operators import repo_stats


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(make(F.col("v")).alias("o"), "i").orderBy("i").collect()]


def random_bytes(seed, count):
    rng = random.Random(seed)
    pieces = [b"a", b"\xc3\xa9", "�".encode(), b"\xe2\x82\xac", "😀".encode(), b"\x01", b"\x01a", b"\x01b",
              b"\xff", b"\xc3", b"\xe2\x82", b"\xf0\x9f\x98", b"\xed\xa0\x80", b"\xc0\x80", b"\x80", b"\xf5", b"\xf0\x80\x80\x80",
              b"\x00", b"\r", b"\n", b"\r\n", b" ", b"7"]
    return [b"".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(count)]


def test_lossy_reading_equals_decode_with_ignore(spark):
    values = random_bytes(1, 3000)
    got = column(spark, values, "binary", text.lossy_text)
    wanted = [v.decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n") for v in values]
    assert got == wanted


def test_strict_reading(spark):
    def valid(value):
        try:
            value.decode("utf-8")
        except UnicodeDecodeError:
            return False
        return b"\0" not in value

    values = random_bytes(2, 2000)
    assert column(spark, values, "binary", text.is_strict_text) == [valid(v) for v in values]


def test_length_rules_differ(spark):
    values = ["x" * 9, "x" * 10, "x" * 11, "é" * 10]
    assert column(spark, values, "string", lambda c: text.within_length(c, 10)) == [True, True, False, True]
    assert [len(v) for v in column(spark, values, "string", lambda c: text.truncate(c, 10))] == [9, 10, 10, 10]


NAMES = [".gitignore", ".env", "a.", "a.tar.gz", "x.env", "Makefile", "..x", "X.PY", "b.c.", "q", "a b.Md", "ü.ä"]


def test_suffix_and_stem_follow_path_rules(spark):
    assert column(spark, NAMES, "string", paths.suffix) == [PurePath(n).suffix.lower() for n in NAMES]
    assert column(spark, NAMES, "string", paths.stem) == [PurePath(n).stem for n in NAMES]


def test_names_round_trip(spark):
    dirs = ["a_b", "a_b_c", "plain", "_x", "a_", "x_y_z_"]
    projects = column(spark, dirs, "string", paths.dir_to_project)
    assert projects == [d.replace("_", "/", 1) for d in dirs]
    assert column(spark, projects, "string", paths.project_to_dir) == dirs


@pytest.mark.parametrize(
    "path, substring, component",
    [
        (".git/config.py", True, True),
        (".github/a.py", True, False),
        ("docs.gitbook/a.py", True, False),
        ("src/.gitignore", False, False),
        ("src/a.git", False, False),
        ("a/.git/b/c.py", True, True),
        ("a.py", False, False),
    ],
)
def test_git_rules(spark, path, substring, component):
    df = spark.createDataFrame([("o_p", path)], "d string, p string")
    got = df.select(paths.under_git_like(F.col("d"), F.col("p")), paths.under_git(F.col("p"))).first()
    assert tuple(got) == (substring, component)


def test_project_named_like_git_host(spark):
    df = spark.createDataFrame([("u_u.github.io", "a.py")], "d string, p string")
    assert df.select(paths.under_git_like(F.col("d"), F.col("p"))).first()[0] is True


def test_stars(spark):
    span = '<a href="/a/b/stargazers" class="x"> <svg/>\n<span title="t">{}</span></a>'
    cases = {
        'aria-label="12 stars"': 12,
        span.format("1.2k"): 1200,
        span.format("3m"): 3_000_000,
        span.format("4.7M"): 4_700_000,
        span.format("17"): 17,
        "nothing": 0,
        'aria-label="1,234 stars"' + span.format("1.2k"): 1200,
        'aria-label="0 stars"' + span.format("9"): 9,
        span.format("1.2.3"): 0,
    }
    assert column(spark, list(cases), "string", H.parse_stars) == list(cases.values())


def test_records_reach_into_neighbours_and_are_used_up_when_accepted(spark):
    record = '<div class="search-title"><a href="/{}">x</a></div>'
    page = (
        record.format("o/first") + "y" * 4000
        + record.format("topics/skip") + 'aria-label="5 stars"'
        + record.format("o/first") + record.format("o/first") + record.format("o/last") + 'aria-label="7 stars"'
    )
    df = spark.createDataFrame([(1, page), (2, "no records")], "page_id long, html string")
    from corpusmill.sources.state import html_records, page_hits

    found = [tuple(r) for r in html_records(df).orderBy("position").collect()]
    assert [(p, n) for _, p, n, _ in found] == [(0, "o/first"), (1, "topics/skip"), (2, "o/first"), (3, "o/first"), (4, "o/last")]
    assert [s for *_, s in found] == [0, 5, 5, 5, 5]
    hits = page_hits(df).orderBy("rank").collect()
    assert [(r.rank, r.full_name, r.stars) for r in hits] == [(0, "o/first", 5), (1, "o/last", 5)]


def test_match_offsets(spark):
    import re

    from corpusmill.constants import RECORD_PATTERN

    record = '<div a search-title>é<a href="/o/n">'
    page = "ü" + record + "😀" + record + record + "end"
    df = spark.createDataFrame([(page,)], "html string")
    got = H.with_matches(df).select("matches").first()[0]
    assert [(m.start, m.end, m.name) for m in got] == [
        (m.start(), m.end(), m.group(1)) for m in re.finditer(RECORD_PATTERN, page)
    ]


def test_extension_classes_and_purge(spark):
    cases = [
        ("LICENSE", 9, "keep"), ("license", 9, "keep"), ("License.bin", 9, "drop"), ("a/.git/x.bin", 9, "ignore"),
        (".github", 9, "keep"), ("Makefile", 9, "keep"), (".env", 9, "keep"), ("a.tar.gz", 9, "drop"),
        ("a.TXT", 2**20, "keep"), ("a.txt", 2**20 + 1, "drop"), ("a.json", 5 * 2**20 + 1, "drop"),
        ("a.csv", 6 * 2**20, "keep"), ("big.py", 9 * 2**20, "keep"), ("x.png", 1, "drop"),
    ]
    df = spark.createDataFrame([(i, p, s) for i, (p, s, _) in enumerate(cases)], "i int, file_path string, size long")
    got = repo_stats.purge_plan(df).orderBy("i").collect()
    assert [r.action for r in got] == [a for *_, a in cases]


def test_token_caps(spark):
    cases = [(".txt", 2**20, True), (".txt", 2**20 + 1, False), (".py", 5 * 2**20, True), (".py", 5 * 2**20 + 1, False)]
    df = spark.createDataFrame([(i, e, s) for i, (e, s, _) in enumerate(cases)], "i int, e string, s long")
    got = df.select("i", repo_stats.token_eligible(F.col("e"), F.col("s")).alias("ok")).orderBy("i").collect()
    assert [r.ok for r in got] == [ok for *_, ok in cases]


def test_token_counts(spark):
    values = ["", "a b", "x=1234", "été!", "def f():\n\treturn 12"]
    assert column(spark, values, "string", tokens.count_tokens) == [0, 2, 4, 2, 7]

    def words(batches):
        for batch in batches:
            yield pd.Series([len(t.split()) for t in batch])

    assert column(spark, values, "string", lambda c: tokens.count_tokens(c, words)) == [0, 2, 1, 1, 4]


def test_missing_vocabulary_is_an_error(spark):
    try:
        tokens._encoding("cl100k_base")
    except RuntimeError as error:
        assert "TIKTOKEN_CACHE_DIR" in str(error)
    else:
        assert column(spark, ["hello world"], "string", lambda c: tokens.count_tokens(c, "cl100k_base")) == [2]


def test_eta(spark):
    cases = {86400.0 * 3: "3.0 days", 7300.0: "2.0 hours", 90.0: "1.5 minutes", 86399.0: "24.0 hours"}
    assert column(spark, list(cases), "double", units.eta_text) == list(cases.values())


def test_user_tokenizers_never_see_a_null(spark):
    from corpusmill.functions.tokens import count_tokens

    def lengths(batches):
        for batch in batches:
            assert batch.notna().all()
            yield batch.str.len()

    df = spark.createDataFrame([("ab",), (None,), ("",), ("abcd",)], "t string").repartition(2)
    got = sorted(df.select("t", count_tokens(F.col("t"), lengths).alias("n")).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([("ab", 2), (None, None), ("", 0), ("abcd", 4)], key=str)


def test_bpe_with_a_tiny_vocabulary(spark):
    import tiktoken

    from corpusmill.functions.tokens import count_tokens

    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"  ": 258}
    tiny = tiktoken.Encoding("tiny", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={"<|end|>": 259})
    texts = ["abc", "ab ab", "", "x<|end|>", None, "é  abcab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    got = {r.i: r.n for r in df.select("i", count_tokens(F.col("t"), tiny).alias("n")).collect()}
    wanted = {i: None if t is None else len(tiny.encode_ordinary(t)) for i, t in enumerate(texts)}
    assert got == wanted and got[0] == 1


def test_an_absent_vocabulary_is_an_error(spark):
    from corpusmill.functions.tokens import count_tokens

    df = spark.createDataFrame([("a",)], "t string")
    with pytest.raises(Exception, match="no_such_vocabulary"):
        df.select(count_tokens(F.col("t"), "no_such_vocabulary")).collect()
