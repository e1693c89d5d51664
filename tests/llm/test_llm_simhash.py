"""Fingerprints against the same hash on the JVM, links and components against all pairs."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tandem.llm import simhash as H
from tandem.llm.graph import components


def brute_print(spark, text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not ws:
        return 0
    parts = [" ".join(ws[i : i + words]) for i in range(max(1, len(ws) - words + 1))]
    hashes = [r[0] % 2**64 for r in spark.createDataFrame([(p,) for p in parts], "t string").select(F.xxhash64("t")).collect()]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_those_of_the_other_hash(spark):
    texts = ["", None, "one", "One  TWO", "a b c", "a\tb\nc d\x0be f", "Ünï códe  and more wörds", "x " * 500, "a\u00a0b c d"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["fp"] % 2**64 for r in H.fingerprints(rows, 3).collect()}
    assert got == {i: brute_print(spark, t, 3) for i, t in enumerate(texts)}


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_all_links_within_the_distance(spark, max_bits):
    rng = random.Random(max_bits)
    fps = {0, -1, 1, -(2**63)}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(12):
            fp = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                fp ^= 1 << b
            fps.add(fp - 2**64 if fp >= 2**63 else fp)
    got = {tuple(r) for r in H.links_of(spark.createDataFrame([(f,) for f in fps], "fp long"), max_bits).collect()}
    near = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) % 2**64).count("1") <= max_bits}
    assert got == near


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(900, 901), (901, 902), (902, 900), (5, 5)]
    links += [(rng.randrange(2000, 2060), rng.randrange(2000, 2060)) for _ in range(40)]
    rng.shuffle(links)
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links] * 2
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    both = set(links) | {(b, a) for a, b in links}
    expected = groups({n for e in links if e[0] != e[1] for n in e}, lambda a, b: (a, b) in both)
    assert got == expected
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def documents(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, i = [], 0
    for _ in range(8):
        base = [word() for _ in range(120)]
        for k in range(6):
            ws = list(base)
            if k > 2:
                ws[rng.randrange(120)] = word()
            rows.append((i, " ".join(ws)))
            i += 1
    rows += [(100, ""), (101, None), (102, " \n"), (None, rows[0][1]), (None, "alone in here with null"), (0, rows[0][1]), (104, "w " * 20000)]
    return rows, spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, fp string")


def test_documents_and_their_components(spark):
    rows, docs = documents(spark)
    prints = [brute_print(spark, t, 3) if len(t or "") < 5000 else H.fingerprint_of(H.shingle_hashes(t, 3)) % 2**64 for _, t in rows]
    root = groups(set(prints), lambda a, b: bin(a ^ b).count("1") <= 2)
    name = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            name[root[p]] = min(i, name.get(root[p], i))
    expected = sorted([(i, f"{p:016x}", name.get(root[p])) for (i, _), p in zip(rows, prints, strict=True)], key=str)
    got = H.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == expected
    kept = H.one_of_each(docs).collect()
    assert sorted([r["doc_id"] for r in kept], key=str) == sorted([*name.values(), None], key=str)
    assert H.one_of_each(docs).columns == docs.columns
    assert H.near_duplicates(docs.where("false")).count() == 0 and H.one_of_each(docs.where("false")).count() == 0
