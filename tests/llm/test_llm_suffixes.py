"""Repeated passages against a search of all windows."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tandem.llm import suffixes as S

SCHEMA = "doc_id long, text string"


def brute(rows, least):
    """Runs of words that lie in windows found in two different (id, text)."""
    holders = defaultdict(set)
    docs = list(dict.fromkeys(rows))
    words = [(text or "").lower().split() for _, text in docs]
    for d, ws in enumerate(words):
        for s in range(len(ws) - least + 1):
            holders[tuple(ws[s : s + least])].add(d)
    out = []
    for d, ws in enumerate(words):
        covered = set()
        for s in range(len(ws) - least + 1):
            if len(holders[tuple(ws[s : s + least])]) > 1:
                covered.update(range(s, s + least))
        runs = []
        for p in sorted(covered):
            if runs and runs[-1][1] == p:
                runs[-1][1] = p + 1
            else:
                runs.append([p, p + 1])
        out += [(docs[d][0], a, b) for a, b in runs]
    return sorted(out, key=str)


def found(spark, rows, **how):
    df = S.repeated_passages(spark.createDataFrame(rows, SCHEMA), **how)
    assert df.columns == ["doc_id", "start_word", "stop_word", "n_words", "partner_id"]
    got = df.collect()
    assert all(r["n_words"] == r["stop_word"] - r["start_word"] for r in got)
    return sorted([(r["doc_id"], r["start_word"], r["stop_word"]) for r in got], key=str), got


def corpus(seed, n_words=3):
    """Texts of few words, so that windows share beginnings, ends and middles with several others."""
    rng = random.Random(seed)
    stock = [[rng.choice("abcdefgh"[:n_words]) for _ in range(rng.randint(6, 25))] for _ in range(6)]
    rows = []
    for i in range(40):
        ws = []
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(stock)
            a = rng.randint(0, len(part))
            ws += part[a : a + rng.randint(1, 20)] + [rng.choice("xyz") for _ in range(rng.randint(0, 3))]
        rows.append((i, " ".join(ws)))
    return rows


@pytest.mark.parametrize("crowd", [100_000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_every_window_that_repeats_is_found(spark, seed, crowd):
    rows = corpus(seed)
    assert found(spark, rows, least=8, seed=4, crowd=crowd)[0] == brute(rows, 8)


def test_a_passage_among_other_words_and_its_partner(spark):
    rng = random.Random(5)
    new = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage = new(60)
    rows = [(i, " ".join(new(30 * i) + passage + new(7))) for i in (1, 2, 3)] + [(9, " ".join(new(200)))]
    spans, got = found(spark, rows)
    assert spans == [(1, 30, 90), (2, 60, 120), (3, 90, 150)]
    assert all(r["partner_id"] in (1, 2, 3) and r["partner_id"] != r["doc_id"] for r in got)


def test_cases_with_a_defined_result(spark):
    long = " ".join(f"w{i}" for i in range(70))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long), (4, long.upper()), (5, "one " * 40000), (6, " ".join(long.split()[:49]))]
    spans, got = found(spark, rows)
    assert spans == sorted([(3, 0, 70), (4, 0, 70), (None, 0, 70)], key=str)
    assert found(spark, [(3, long), (3, long)])[0] == []
    assert S.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, long, 5, 6), (2, long, 5, 6)], "doc_id long, text string, doc long, seed long")
    assert S.repeated_passages(clash).count() == 2


def test_rows_that_repeat_id_and_text_are_one_row_before_they_are_joined(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(None, long)] * 60 + [(3, long)] * 40 + [(4, long), (5, "other"), (None, None), (None, None)]
    docs = S._documents(spark.createDataFrame(rows, SCHEMA), "doc_id", "text")
    assert sorted(((r["has_id"], r["id"]) for r in docs.collect())) == [(False, 0), (False, 0), (True, 3), (True, 4), (True, 5)]
    kept = S._suffixes(docs, 50, 25)
    every = np.full(S.BITS // 32, 2**32 - 1, np.uint32)
    assert S._with_words(docs, every, 0 * every, 50, 25, crowds=False).count() == kept.count() > 0
    for crowd in (100_000, 2):
        assert found(spark, rows, crowd=crowd)[0] == brute(rows, 50)


def test_a_full_field_of_seeds_changes_nothing(spark, monkeypatch):
    rows = corpus(4)
    expected = found(spark, rows, least=5, seed=3)[0]
    monkeypatch.setattr(S, "BITS", 64)
    monkeypatch.setattr(S, "CHUNK", 200)
    assert found(spark, rows, least=5, seed=3)[0] == found(spark, rows, least=5, seed=3, crowd=2)[0] == expected == brute(rows, 5)
