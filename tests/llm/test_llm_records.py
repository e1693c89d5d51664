"""Records against the tokenizer library, exact round trips, damage and reads by the index."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tandem.llm import records as R
from tandem.session import work_folder

public = pytest.importorskip("public_tokenizers")
FILE = public.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def texts(n=150):
    rng = random.Random(8)
    bits = ["the", "Straße", "ça", "ǅa", " 日本", "ªº", "x", "The", "It's", "don't ", " ", "  ", "\n", "\n\n", "\t", "é", "日本", "🙂", "x1", "12", ".", ", ", " ", "\x1c", "\0", "<|endoftext|>", "\r\n", " \n "]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", " ", "\n", "a b c\nd e"]


@pytest.mark.parametrize("remembered", [100_000, 3])
def test_pieces_give_the_ids_of_the_whole_text(library, remembered):
    pieces = R.Pieces(FILE, 2, remembered)
    every = texts()
    for _ in range(2):
        for text, ids in zip(every, pieces.batch(every), strict=True):
            assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("parts", ["1", "4", "30"])
def test_files_in_the_order_of_ids(spark, library, parts):
    rows = list(enumerate(texts(60))) + [(7, "again"), (7, "again"), (None, "no id"), (900, None), (-5, "long " * 30000)]
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA + ", has_id int, ids string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = R.write_and_read(table, FILE, end_id=2).collect()
        assert R.write_and_read(table.where("false"), FILE, end_id=2).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected, start = [], 0
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    raw = lambda ids: np.array(ids, "<u2").tobytes()
    for i, ids in sorted(encoded, key=lambda r: (r[0] is not None, r[0] or 0, raw(r[1]))):
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected


def test_reads_by_the_index_in_any_order(spark, library):
    table = spark.createDataFrame(list(enumerate(texts(40))), SCHEMA)
    folder = work_folder(spark, "records-test")
    written = R.write_records(table, folder, FILE, end_id=2)
    seen = {}
    for _, path, n, n_tokens, _ in written:
        index = R.offsets_of(folder, path)
        assert len(index) == n
        whole = list(R.records_of(folder, path))
        for k in random.Random(2).sample(range(n), n):
            doc, ids = R.record_at(folder, path, index[k][0])
            assert doc == whole[k][0] and ids.tolist() == whole[k][1].tolist()
            assert index[k][1] == sum(len(w[1]) for w in whole[:k])
            seen[doc] = ids.tolist()
        assert n_tokens == sum(len(w[1]) for w in whole)
    assert seen == {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts(40))}


def test_any_changed_byte_is_noticed(tmp_path):
    data = R.frame(R.payload_of(5, np.arange(9, dtype="<u2").tobytes(), 2)) + R.frame(R.payload_of(None, b"", 4))
    file = tmp_path / "a.rec"
    file.write_bytes(data)
    assert [(d, i.tolist()) for d, i in R.records_of(str(tmp_path), "a.rec")] == [(5, list(range(9))), (None, [])]
    for at in range(len(data)):
        file.write_bytes(data[:at] + bytes([data[at] ^ 4]) + data[at + 1 :])
        with pytest.raises(R.Damaged):
            list(R.records_of(str(tmp_path), "a.rec"))
    for end in range(1, len(data)):
        file.write_bytes(data[:end])
        try:
            assert len(list(R.records_of(str(tmp_path), "a.rec"))) == 1  # a cut between two records
        except R.Damaged:
            pass


def test_words_and_other_pieces_of_every_kind(library):
    pieces = R.Pieces(FILE, 2)
    assert pieces.letters is not None
    given = [" the", "the", " Übergrößenträger", "naïve", " ña", "ª", "x", " ", "é", " x1", "it's", "<|endoftext|>", " ÿ", "\u0250a", "", "ſ", "µm", '"abc', "'sabc", "1abc", "-abc", "\nabc", ".The", "  ab", " \u00a0a", " word,", "end.", "Of%%%", "a's", "so...", " x|", "a.b", "(a)", "mot»", " a² ", "it'"]
    for piece, ids in pieces.encode(given).items():
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(piece, add_special_tokens=False).ids, piece
    other = R.Pieces(public.path("word_bpe_49k.json"), 4)
    assert other.letters is None
