import hashlib
import random
import re

from corpusmill.llm import queries, secret_scan
from tests.llm import helpers

KEYWORD = "(?:" + "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ["password", "passwd", "secret", "token"])
KEYWORD += "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"


def by_definition(text):
    found = [
        (m.start(), 0, m.end())
        for m in re.finditer(KEYWORD + "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)
        if len(m[1]) >= 8
    ]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(found))


def texts():
    rng = random.Random(5)
    parts = ["token", "SECRET", "api_key", "ApiKey", "passwd", "=", ":", '"', "'", " ", "abc", "AKIA", "Z9" * 7, "0f" * 17, "é", "\n", "ſecret", "toKen"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(600)] + [
        "token=secret:longvalue123", "AKIA" + "A" * 12, "AKIA" + "A" * 11, "f" * 31, "f" * 32, "xx" + "a" * 40 + "g",
    ]


def test_base_spans_by_definition(spark, tmp_path):
    own = texts()
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, [*own, None]))
    rows = {r.doc_id: r for r in queries.op5_secret_scan(spark, sf).collect()}
    for i, text in enumerate([*own, ""]):
        spans = by_definition(text)
        assert rows[i].base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), text
        assert [rows[i].n_assign, rows[i].n_access, rows[i].n_hex] == [spans.count(k) for k in ("assign", "access", "hex")]
        base = [s for s in rows[i].spans.split(",") if s and not s.startswith("novel")]
        assert ",".join(base) == spans


RANDOM = "q7Zr0XvB2mKd93LwTfH5yNcGj8sPaQeU"


def kinds(text):
    base, novel = secret_scan.spans_of(text)
    return [text[a:b] for a, _, b in novel], len(base)


def test_novel_strings_near_sensitive_words():
    assert kinds(f"Authorization: Bearer {RANDOM} ok") == ([RANDOM], 0)
    assert kinds(f"the private key is {RANDOM}.") == ([RANDOM], 0)
    assert kinds(f"nothing to see {RANDOM}") == ([], 0)
    assert kinds("the private key is getUserAccountIdentifier1 here") == ([], 0)
    assert kinds("credential: zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1") == ([], 0)
    assert kinds(f'token = "{RANDOM}"') == ([], 1)
    repeated = f"bearer {RANDOM} and bearer {RANDOM}"
    assert kinds(repeated) == ([RANDOM, RANDOM], 0)


def test_novel_strings_anywhere_within_reach():
    for gap in (1, 31, 32, 33, 47, 48):
        assert kinds("the private key" + " " * gap + RANDOM) == ([RANDOM], 0), gap
        assert kinds(RANDOM + " " * gap + "private key") == ([RANDOM], 0), gap
    assert kinds("the private key" + " " * 49 + RANDOM) == ([], 0)
    assert kinds(RANDOM + " " * 49 + "private key") == ([], 0)


def test_novel_strings_of_any_characters():
    rng = random.Random(6)
    letters = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", k=40))
    broken = "q7Zr0!XvB2@Kd93.wTfH$yNcG#8sPa%eU"
    assert kinds(f"the passphrase is {letters} here") == ([letters], 0)
    assert kinds(f"bearer {broken}.") == ([broken], 0)
    assert kinds("the credential of internationalization") == ([], 0)


def test_sensitive_words_part_a_run():
    assert kinds(f"bearer{RANDOM}") == ([RANDOM], 0)
    assert kinds(f"{RANDOM}bearer") == ([RANDOM], 0)


def test_marginal_bytes():
    assert secret_scan.marginal_bytes(RANDOM, "") >= len(RANDOM) * 0.8
    assert secret_scan.marginal_bytes("authorization_token_password", "") < 20


def test_redaction(spark):
    df = helpers.odd(spark, [f'a token = "{RANDOM}" b', f"bearer {RANDOM}", "plain"])
    made = secret_scan.redact_secrets(df)
    assert made.columns == df.columns and made.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    rows = {r.doc_id: r for r in made.collect()}
    assert rows[10].text == 'a [SECRET]" b' and rows[10].n_chars == len(rows[10].text)
    assert rows[11].text == "bearer [SECRET]" and rows[12].text == "plain" and rows[0].text is None
    assert rows[3].n_chars == 10 and rows[3].spans == "own spans"


def test_odd_tables(spark):
    found = secret_scan.scan_secrets(helpers.odd(spark))
    assert found.columns == ["row", "result"] and found.where("size(result.spans) > 0").count() == 0
    assert found.count() == 8
    assert secret_scan.scan_secrets(helpers.empty(spark)).count() == 0
    assert secret_scan.redact_secrets(helpers.empty(spark)).count() == 0
