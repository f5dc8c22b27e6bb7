import random

import numpy as np

from corpusmill.llm import language_id


def plain_grams(text):
    """Windows of four bytes of the lower-case text between blanks, other than letters a blank."""
    raw = b" " + text.lower().encode() + b" "
    raw = bytes(c if c >= 0x80 or chr(c).isalpha() else 32 for c in raw)
    return [raw[i : i + 4] for i in range(len(raw) - 3) if raw[i : i + 4] != b"    "]


def plain_counts(grams, bits, texts):
    """The filters as plain sets of slots, asked one n-gram and one language after the other."""

    def slots(gram):
        number = int.from_bytes(gram, "big")
        return [(number * m & (1 << 64) - 1) >> (64 - bits) for m in language_id.MULTIPLIERS[: language_id.HASHES]]

    out = []
    for text in texts:
        row, own = [], plain_grams(text)
        for lang in sorted(grams):
            filled = {s for g in grams[lang] for s in slots(g)}
            wrong = (len(filled) / 2**bits) ** language_id.HASHES
            hits = sum(all(s in filled for s in slots(g)) for g in own)
            row.append(max(0.0, (hits - wrong * len(own)) / (1 - wrong)))
        out.append(row)
    return np.array(out)


def test_counts_against_brute_force():
    rng = random.Random(7)
    letters = {"aa": "abcde", "bb": "abxyé", "cc": "klmno", "dd": "abcde"}
    learned = {k: {g for _ in range(40) for g in plain_grams("".join(rng.choices(v, k=9)))} for k, v in letters.items()}
    learned["dd"] = learned["aa"]  # equal languages tie everywhere
    filters = language_id.Filters({k: np.array([int.from_bytes(g, "big") for g in v], np.uint32) for k, v in learned.items()})
    texts = ["", "1 2 3", "a", "ÉÉ bb", *("".join(rng.choices("abcde xyé klmno 12.", k=rng.randint(1, 60))) for _ in range(60))]
    found, lengths = filters.counts(texts)
    assert lengths.tolist() == [len(plain_grams(t)) for t in texts]
    assert np.allclose(found, plain_counts(learned, filters.bits, texts), atol=1e-9)
    tied = found[:, 0] == found[:, 3]
    assert tied.all() and not (found.argmax(1) == 3).any()  # the first in order of names wins
