"""Span equality and extensions against the texts themselves, and rows beside their neighbours."""

from __future__ import annotations

import hashlib
import random

import pytest

from tandem.llm import fingerprints as P

SCHEMA = "doc_id long, text string"


def head(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_spans_and_extensions_of_any_two_places():
    rng = random.Random(1)
    for _ in range(200):
        part = "".join(rng.choice("ab🙂") for _ in range(rng.randint(0, 30)))
        a = "".join(rng.choice("ab🙂") for _ in range(rng.randint(0, 9))) + part + rng.choice("abx")
        b = "".join(rng.choice("ab🙂") for _ in range(rng.randint(0, 9))) + part + rng.choice("aby")
        x, y = P.Fingerprint(a), P.Fingerprint(b)
        for _ in range(20):
            i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
            assert P.common_extension(x, i, y, j) == head(a[i:], b[j:])
            n = rng.randint(0, min(len(a) - i, len(b) - j))
            assert P.same_span(x, i, y, j, n) == (a[i : i + n] == b[j : j + n])
        assert P.common_ending(x, y) == head(a[::-1], b[::-1])
        assert (x.digest() == y.digest()) == (a == b)


def test_likeness():
    like = lambda a, b: P.likeness(P.Fingerprint(a), P.Fingerprint(b))
    assert like("", "") == 1 and like("", "a") == 0 and like("abc", "abc") == 1
    assert like("abcd", "abXd") == 0.75 and like("aaaa", "aa") == 0.5 and like("aaa", "aaab") == 0.75


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        new = text[: len(text) - cut] + after[:cut]
        whole = []
        for other in (new, after):
            h = head(text, other)
            end = min(head(text[::-1], other[::-1]), min(len(text), len(other)) - h)
            whole.append((h + end) / max(len(text), len(other)) if text or other else 1.0)
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), *whole))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_each_document_and_the_next(spark, parts):
    rng = random.Random(9)
    rows = [(i * 7 % 83, "".join(rng.choice("abc é🙂") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(5, None), (5, "twice"), (5, "twice"), (None, "no id"), (None, "no id 2"), (2000, "z" * 50000), (-3, "")]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", _bucket int, id string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = P.compare_with_next(table).collect()
        assert P.compare_with_next(table.where("false")).count() == 0
        one = P.compare_with_next(spark.createDataFrame([(4, "abcdefgh")], SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    plain = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got]
    assert sorted(plain, key=str) == brute(rows)
    assert [(r["edited_sha256"], r["near_next"]) for r in one] == [(hashlib.sha256(b"abcdefab").hexdigest(), 1.0)]
    assert len({r["fingerprint"] for r in got}) == len({t or "" for _, t in rows})
