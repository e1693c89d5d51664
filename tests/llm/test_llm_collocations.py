"""Phrase collocations against a plain count."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tandem.llm import collocations as op

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least=10, share=50, first=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        longer = Counter()
        for p, c in counts.items():
            if len(p) == 3 and c >= least:
                longer[p[:2]], longer[p[1:]] = max(longer[p[:2]], c), max(longer[p[1:]], c)
        scored = []
        for p, a in counts.items():
            if len(p) > 1 and a >= least and 100 * longer[p] < share * a:
                score, _, left, right = min(
                    (1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
                )
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return Counter(out)


def found(spark, rows, **options):
    df = op.collocations(spark.createDataFrame(rows, SCHEMA), **options)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return Counter(map(tuple, df.collect()))


def made_up(seed, docs):
    rng = random.Random(seed)
    words = ["a", "B", "a\x01", "é", "É", "the", "of", "x-y", "日本", "z" * 70, "c", "d", "\u0085"]
    weights = [9, 7, 2, 3, 1, 12, 11, 4, 2, 1, 5, 4, 1]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts += [rng.choices(words, weights)[0], rng.choices([" ", "\t", "  ", ". ", "\n", ",", "!", "\x0b"], [30, 3, 3, 1, 1, 1, 1, 1])[0]]
        rows.append((i, "".join(parts), rng.choice(["en", "fr", None, "und", ""])))
    return rows


@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_counts_scores_and_ranks(spark, monkeypatch, parts):
    monkeypatch.setattr(op, "CHUNK", 900)
    monkeypatch.setattr(op, "SENT", 50)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = made_up(4, 400)
        assert found(spark, rows, least=3) == expected(rows, 3)
        assert found(spark, rows, least=10, share=20, first=7) == expected(rows, 10, 20, 7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_full_field_of_pairs_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(op, "BITS", 32)
    rows = made_up(8, 150)
    assert found(spark, rows, least=4) == expected(rows, 4)


def test_odd_tables(spark):
    assert not found(spark, [(1, None, "en"), (2, "", None), (3, " .;\n", "en")])
    empty = spark.createDataFrame([], SCHEMA)
    assert op.collocations(empty).count() == 0
    rows = [(1, "same again and " * 30, "en")] * 40 + [(None, "one two", None)] * 12 + [(5, "w " * 300_000 + "end", "de")]
    assert found(spark, rows) == expected(rows)
    clashing = spark.createDataFrame([(1, "p q " * 12, "en", "x", 1, "w")], f"{SCHEMA}, phrase string, n int, words string")
    assert Counter(map(tuple, op.collocations(clashing).collect())) == expected([(1, "p q " * 12, "en")])


def test_scores_are_exact_beyond_64_bits(spark):
    numbers = [(10**15 - 1, 10**15 - 1, 10**15 - 1), (10**14 + 7, 10**15 - 3, 10**14 + 9), (3, 10**9, 10**9), (1, 1, 1), (999_999_937, 10**12 + 39, 10**9 + 7)]
    df = spark.createDataFrame(numbers, "a long, l long, r long")
    rows = df.select("a", "l", "r", op.cut_score(F.col("a"), F.col("l"), F.col("r")).alias("score")).collect()
    assert all(r.score == 1_000_000 * r.a * r.a // (r.l * r.r) for r in rows)


def test_what_ranges_hand_on():
    row = lambda *v: SimpleNamespace(**dict(zip(("part", "one", "two", "lead", "has_short"), v, strict=True)))
    rows = [row(0, 9, 5, 0, True), row(1, -1, -1, 4, False), row(2, -1, -1, 3, False), row(3, 7, 6, 2, True), row(5, 1, -1, 0, True)]
    assert op._handed_on(rows) == {0: (0, 0, 4), 1: (9, 5, 3), 2: (9, 5, 2), 3: (9, 5, 0), 5: (7, 6, 0)}


def test_borders_agree_with_one_pass(spark):
    """The same stream, whatever batches it comes in."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows, seen = made_up(6, 200), []
    for size in ("3", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        seen.append(found(spark, rows, least=3))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert seen[0] == seen[1] == expected(rows, 3)


def test_words_of_a_column():
    texts = pa.array(["Ab c", None, "", "  x\ty.z ", "É é", "q" * 5000])
    words = op.Words(pa.array(["en"] * 6), texts)
    assert words.spelt.to_pylist() == sorted(["ab", "c", "x", "y", "z", "É", "é", "q" * 5000], key=str.encode)
    assert words.joined.tolist() == [True, False, True, False, False, True, False]
