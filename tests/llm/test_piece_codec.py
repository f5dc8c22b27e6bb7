import random

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import piece_codec as P
from corpusmill.llm import queries
from tests.llm import helpers

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    """The public model with the search switched to Unigram; its marks for unused pieces, far below
    what the library's single precision can add up, become an ordinary low score."""
    from sentencepiece import sentencepiece_model_pb2

    with open(queries.TOKENIZER, "rb") as file:
        proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.score < -1e8:
            piece.score = -40_000
    return proto.SerializeToString()


def samples():
    rng = random.Random(7)
    syllables = ["the", "tion", "er", "é", "ung", "ß", "日", "本", "\U0001f600", "qz", "##", "7", ".", ",", "\t", "\r"]
    made = [
        "".join(rng.choice(syllables) + rng.choice(["", "", " ", "\n"]) for _ in range(rng.randint(0, 25))) for _ in range(400)
    ]
    return [*made, "", " ", "  a", "a  ", "\n\n", "x" * 500, "hello " * 50, "\x00", "no​break"]


def test_same_pieces_as_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = P.load(model)
    texts = samples()
    ids, ends = P.Encoder(codec).encode(texts)
    for i, text in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == library.encode(text), text
    assert P.decode_ids(ids, ends, codec) == texts


def best_score(text, codec):
    """Brute force over all cuts."""
    pieces = {}
    for i in range(len(codec.scores)):
        raw = codec.surface[codec.surface_at[i] : codec.surface_at[i + 1]].tobytes().decode()
        pieces[raw.replace(" ", P.MARK)] = codec.scores[i]
    best = {0: 0.0}
    for end in range(1, len(text) + 1):
        found = [best[start] + pieces[text[start:end]] for start in range(end) if text[start:end] in pieces]
        if text[end - 1 : end] not in pieces:
            found.append(best[end - 1] + codec.unknown_score)
        best[end] = max(found)
    return best[len(text)]


@pytest.mark.parametrize("bytes_too", [True, False])
def test_best_cut_against_brute_force(bytes_too):
    rng = random.Random(3)
    names = sorted({"".join(rng.choices("ab▁c", k=rng.randint(1, 4))) for _ in range(40)} | {"a", "b", P.MARK})
    names = [n for n in names if P.MARK not in n[1:]]
    pieces = [("<unk>", 0.0, P.UNKNOWN), *((n, -rng.random() * 9, P.NORMAL) for n in names)]
    if bytes_too:
        pieces += [(f"<0x{b:02X}>", 0.0, P.BYTE) for b in range(256)]
    codec = P.codec(pieces, dummy_prefix=True, squeeze=False, byte_fallback=bytes_too)
    encoder = P.Encoder(codec)
    texts = ["".join(rng.choices("abc d", k=rng.randint(0, 30))) for _ in range(200)]
    ids, ends = encoder.encode(texts)
    plain = P.codec(pieces[: 1 + len(names)], True, False, False)
    for i, text in enumerate(texts):
        own = ids[ends[i] : ends[i + 1]].tolist()
        prepared = P.prepared(text, codec)
        lost = sum(ch not in names for ch in prepared)
        score = sum(codec.scores[j] for j in own if j not in codec.bytes_at and j != codec.unknown)
        if bytes_too or not lost:
            unknown = sum(j in codec.bytes_at for j in own) if bytes_too else 0
            assert abs(score + unknown * codec.unknown_score - best_score(prepared, plain)) < 1e-9
    if bytes_too:
        assert P.decode_ids(ids, ends, codec) == texts


def test_long_chunks_agree_with_short_ones(model):
    codec = P.load(model)
    encoder = P.Encoder(codec)
    for text in ["thetionerung" * 30, "日本" * 40 + "qz", "\U0001f600" * 20]:
        raw = P.prepared(text, codec).encode()
        many, _ = P.search_many([raw], codec)
        assert many.tolist() == P.search_one(raw, codec, encoder.lists)


def test_forgetting_changes_nothing(model, monkeypatch):
    codec, texts = P.load(model), samples()
    wanted, _ = P.Encoder(codec).encode(texts)
    monkeypatch.setattr(P, "REMEMBERED", 50)
    encoder = P.Encoder(codec)
    assert [i for t in texts for i in encoder.encode([t])[0].tolist()] == wanted.tolist()


def test_odd_tables(spark, model):
    codec = P.load(model)
    coded = P.encode(helpers.odd(spark), codec, verify=True)
    assert coded.columns == ["row", "result"]
    rows = coded.collect()
    assert len(rows) == 8 and all(r.result.exact for r in rows)
    by_id = {r.row.doc_id: r for r in rows}
    assert by_id[0].result.ids == [] and by_id[1].result.n_tokens == 0
    assert by_id[3].row.result == "own result"
    back = P.decode(coded.select("row.doc_id", "row.text", "result.ids"), codec)
    assert back.where(F.col("result.text") != F.coalesce("row.text", F.lit(""))).count() == 0
    assert P.encode(helpers.empty(spark), codec).count() == 0
    nothing = spark.createDataFrame([(None,), ([-5, 10**6, None],)], "ids array<int>")
    assert [r.result.text for r in P.decode(nothing, codec).collect()] == ["", ""]


def test_query(spark, tmp_path):
    sf = helpers.tables(spark, tmp_path, documents=helpers.documents(spark, ["the the", None, "日本 x\n"]))
    rows = {r.doc_id: r for r in queries.op1_sentencepiece(spark, sf).collect()}
    assert all(r.exact and r.n_tokens == len(r.ids) for r in rows.values())
    assert rows[2].n_byte_tokens >= 1


def test_shipped_model_against_brute_force():
    """The codec that the queries use, unaltered: whole texts have the best sum of its scores."""
    import pyarrow.parquet as pq
    from sentencepiece import sentencepiece_model_pb2

    with open(queries.TOKENIZER, "rb") as file:
        raw = file.read()
    codec = P.load(raw)
    own = {p.piece: p.score for p in sentencepiece_model_pb2.ModelProto.FromString(raw).pieces if p.type in (P.NORMAL, 4)}
    longest = max(map(len, own))
    column = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column(0).to_pylist()
    texts = sorted({t for t in column if t}, key=lambda t: (len(t), t))[:40] + samples()[:40]
    ids, ends = P.Encoder(codec).encode(texts)
    for i, text in enumerate(texts):
        whole = P.prepared(text, codec)
        best = [0.0]
        for end in range(1, len(whole) + 1):
            cuts = [best[a] + own[whole[a:end]] for a in range(max(0, end - longest), end) if whole[a:end] in own]
            if whole[end - 1] not in own:
                cuts.append(best[end - 1] + codec.unknown_score)
            best.append(max(cuts))
        found = [j for j in ids[ends[i] : ends[i + 1]].tolist() if j not in codec.bytes_at and j != codec.unknown]
        lost = sum(c not in own for c in whole)
        assert abs(sum(float(codec.scores[j]) for j in found) + lost * codec.unknown_score - best[-1]) < 1e-3, text
