"""Jaccard links against all pairs, and the parts of the tree."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tandem.llm import jaccard as op
from tandem.llm import words as w
from tandem.llm.graph import united

SCHEMA = "doc_id long, text string"


def set_of(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def expected(rows, percent=85, size=4):
    sets = [set_of(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return Counter((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows))


def found(spark, rows, **options):
    df = op.similar_documents(spark.createDataFrame(rows, SCHEMA), **options)
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return Counter(map(tuple, df.collect()))


def made_up(seed, families, near):
    """Families of texts with a few words changed, around the border of the similarity, and a passage that many share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choices(words, k=25))
    rows, number = [], 0
    for _ in range(families):
        base = rng.choices(words, k=rng.randint(1, 90))
        if rng.random() < 0.4:
            base += passage.split()
        for _ in range(rng.randint(1, near)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(copy) // 30)):
                at = rng.randrange(len(copy) + 1)
                copy[at : at + rng.randint(0, 1)] = rng.choices(words, k=rng.randint(0, 2))
            rows.append((number * 3 % 1009, rng.choice([" ", "  ", "\n"]).join(copy).swapcase() if rng.random() < 0.2 else " ".join(copy)))
            number += 1
    return rows


@pytest.mark.parametrize("percent", [85, 60])
def test_links_of_families(spark, percent):
    rows = made_up(2, 60, 6)
    assert found(spark, rows, percent=percent) == expected(rows, percent)


def test_crowded_cells_are_met_leaf_by_leaf(spark, monkeypatch):
    monkeypatch.setattr(op, "LEAF", 8)
    monkeypatch.setattr(op, "NODE", 3)
    monkeypatch.setattr(op, "POINTS", 20)
    monkeypatch.setattr(op, "PAIRS", 64)
    monkeypatch.setattr(op, "HEAVY", 2)
    monkeypatch.setattr(op, "CHUNK", 2000)
    rows = made_up(7, 12, 25)
    assert found(spark, rows) == expected(rows)


def test_a_chain_of_neighbours_is_one_component(spark):
    words = [f"v{i}" for i in range(400)]
    rows = [(900 - i, " ".join(words[i * 4 : i * 4 + 120])) for i in range(60)]
    assert found(spark, rows) == expected(rows)
    assert len({c for _, _, c in expected(rows)}) == 1


def test_odd_rows(spark):
    text = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, " \t\n"), (2, ""), (4, "a"), (5, "A"), (6, "a b"), (None, "a b"), (None, None), (None, text)]
    rows += [(8, text)] * 3 + [(7, text.upper()), (9, "a b c"), (10, "a b c"), (11, "é É é"), (12, "É É é"), (None, "alone here")]
    rows += [(13, "long " * 200_000 + "end of it"), (14, " ".join(f"x{i}" for i in range(70_000)))]
    assert found(spark, rows) == expected(rows)
    assert op.similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    clashing = spark.createDataFrame([(1, text, 5, "x", 2), (0, text, 6, "y", 3)], f"{SCHEMA}, n int, class string, id int")
    assert Counter(map(tuple, op.similar_documents(clashing).collect())) == Counter({(1, 4, 0): 1, (0, 4, 0): 1})


def test_words_and_shingles_of_a_column():
    rng = random.Random(1)
    texts = ["".join(rng.choices("aB é\t\n日\x0bz", k=rng.randint(0, 40))) for _ in range(300)] + [None, "", "q" * 500, "Q" * 500 + " r", "q" * 501]
    column = pa.array(texts)
    data, at = w.bytes_of(column)
    parts = w.table_of(w.WHITE)
    starts, ends, first = w.find_words(data, at, parts)
    plain = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(first).tolist() == [len(p) for p in plain]
    flat = [x for p in plain for x in p]
    assert w.as_words(data, parts, starts, ends).cast(pa.large_binary()).to_pylist() == flat
    hashes = w.hash_words(data, starts, ends)
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    bounds, tokens = op.sets_of(column, 4)
    assert np.diff(bounds).tolist() == [len(set_of(t)) for t in texts]
    sliced = op.sets_of(column.slice(100, 50), 4)[1]
    assert sliced.tolist() == tokens[bounds[100] : bounds[150]].tolist()
    names, classes = [set_of(t) for t in texts], op.class_of(bounds, tokens).tolist()
    assert len(set(zip(names, classes, strict=True))) == len(set(names)) == len(set(classes))


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (rng.integers(0, 500, 200).astype(np.uint64) for _ in range(2))
        both = [np.unique(w.mixed(x)) for x in (a, b)]
        points = [np.bincount((x >> np.uint64(57)).astype(int), minlength=128) for x in both]
        assert np.minimum(*points).sum() >= len(np.intersect1d(*both))


def test_the_order_ranks_shingles_of_rare_words_first():
    hashes = w.mixed(np.arange(1, 9, dtype=np.uint64))
    table = lambda n: {"token": np.sort(hashes[:3]), "n": n[np.argsort(hashes[:3])], "seen": np.ones(1 << 22, bool)}
    order = op.Order(table(np.array([1, 7, 1000])), table(np.array([3, 9, 5])))
    assert order.of_words(hashes).tolist() == [1, 3, 10, 0, 0, 0, 0, 0]
    ranks = order.of_shingles(hashes, np.arange(8))
    assert np.argsort(ranks, kind="stable").tolist() == [3, 4, 5, 6, 7, 0, 2, 1]
    words, first = op.all_words(pa.array(["a b c a b c", "", "a b", "b"]))
    bounds, _, sums = op.distinct_shingles(words, first, 2, np.array([1, 2, 4, 1, 2, 4, 1, 2, 2]))
    assert bounds.tolist() == [0, 3, 3, 4, 5] and sorted(sums[:3].tolist()) == [3, 5, 6] and sums[3:].tolist() == [3, 2]


def test_pairs_of_runs():
    i, j = op._products(np.array([0, 5]), np.array([2, 1]), np.array([10, 20]), np.array([2, 3]))
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 10), (0, 11), (1, 10), (1, 11), (5, 20), (5, 21), (5, 22)]


@pytest.mark.parametrize("cuts", [(1,), (2, 3), (7,), (100,)])
def test_repeated_tokens_across_batches(cuts):
    tokens, classes = [1, 1, 2, 2, 3, 3, 3, 4, 6, 6], [0, 1, 2, 2, 4, 5, 5, 7, 8, 9]
    whole = pa.RecordBatch.from_arrays([pa.array(classes), pa.array(tokens)], ["class", "token"])
    batches, at = [], 0
    while at < 10:
        for c in cuts:
            batches.append(whole.slice(at, c))
            at += c
    kept = [x for b in op._repeated(iter(batches)) for x in b.column("class").to_pylist()]
    assert sorted(kept) == [0, 1, 4, 5, 8, 9]


@pytest.mark.parametrize("most", [1_000, 40])
def test_links_united_by_tasks(spark, most):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    df = spark.createDataFrame(links, "u long, v long")
    parts = {n: {n} for link in links for n in link if link[0] != link[1]}
    for u, v in links:
        if u != v and parts[u] is not parts[v]:
            parts[u] |= parts[v]
            for n in parts[v]:
                parts[n] = parts[u]
    assert {tuple(r) for r in united(df, "test", most).collect()} == {(n, min(p)) for n, p in parts.items()}
    assert united(df.where("false"), "test", most).count() == 0
