"""The search against all segmentations and against the library's own unigram search of the same pieces."""

from __future__ import annotations

import hashlib
import random

import pytest

from tandem.llm import pieces as Q

public = pytest.importorskip("public_tokenizers")
FILE = public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The same pieces as a unigram model, with scores so small that the library's 32-bit sums stay exact enough."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(FILE, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        if p.type == 1:
            p.score = max(-40.0, p.score / 1024)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return sentencepiece.SentencePieceProcessor(model_file=str(path)), Q.Vocabulary.load(str(path))



def made(n, bits, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_the_best_of_all_segmentations():
    pieces = {p: (i, s) for i, (p, s) in enumerate([("a", -3.0), ("b", -3.0), ("ab", -4.5), ("ba", -4.0), ("aba", -7.0), ("bab", -6.5), ("▁", -2.0), ("▁a", -4.0), ("abab", -9.0)])}
    v = Q.Vocabulary(pieces, None, 99, [p.replace("▁", " ").encode() for p in pieces] + [b"?"] * 91)

    def best(text):
        if not text:
            return 0.0
        return max(
            [pieces[text[:k]][1] + best(text[k:]) for k in range(1, min(4, len(text)) + 1) if text[:k] in pieces]
            + ([v.no_piece + best(text[1:])] if text[0] not in pieces else [])
        )

    for text in ["".join(random.Random(i).choice("ab▁x") for _ in range(i % 13)) for i in range(200)]:
        search = Q.Search(v)
        search.ASK = 3
        ids = search.feed(text) + search.finish()
        got = sum(v.no_piece if i == 99 else list(pieces.values())[i][1] for i in ids)
        assert got == pytest.approx(best(text)), text


def test_ids_equal_the_library_and_come_back_as_the_text(unigram):
    library, v = unigram
    encoder = Q.Encoder(v)
    for text in made(400, ["the", "of", "ing", " ", "  ", "é", "日", "a", "x", "ABC", ".", "tion", "Ünter"]):
        assert encoder.encode(text).tolist() == library.encode(text), repr(text)
    for text in made(300, ["the", " ", "  ", "\n", "\t", "🙂", "𐍈", "\0", "é", "abc"]):
        assert v.decode(encoder.encode(text).tolist()) == text


def test_units_change_nothing_and_the_window_stays_small():
    v = Q.Vocabulary.load(FILE)
    encoder = Q.Encoder(v)
    widest = 0
    for text in [*made(200, ["the", "of", " ", "   ", "\n", "🙂", "tion"]), "antidisestablishmentarianism" * 400]:
        search = Q.Search(v)
        ids = []
        marked = Q.SPACE + text.replace(" ", Q.SPACE) if text else ""
        for k in range(0, len(marked), 7):
            ids += search.feed(marked[k : k + 7])
            widest = max(widest, len(search.text))
        ids += search.finish()
        assert ids == encoder.encode(text).tolist(), repr(text)
    assert widest < 400


def test_rows_with_a_defined_result(spark):
    rows = [(1, None), (2, ""), (3, "One two\n three "), (3, "One two\n three "), (None, "🙂 " * 20000), (4, "a▁b")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_ids int")
    got = Q.round_trips(docs, FILE).collect()
    none = hashlib.sha256(b"").hexdigest()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 6 and by[1]["ids_sha256"] == by[2]["decoded_sha256"] == none and by[1]["n_ids"] == 0
    assert by[None]["round_trip"] and by[3]["round_trip"] and not by[4]["round_trip"]
    ids = Q.encode_documents(docs, FILE)
    assert ids.columns == ["doc_id", "text", "n_ids", "ids"]
    back = Q.decode_documents(ids.drop("text"), FILE).select("doc_id", "text").collect()
    assert {r["doc_id"]: r["text"] for r in back} == {1: "", 2: "", 3: rows[2][1], None: rows[4][1], 4: "a b"}
    assert Q.round_trips(docs.where("false"), FILE).count() == 0
