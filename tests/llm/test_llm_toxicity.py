"""The automata against plain edit distances, context, and accuracy on rows that were not learned from."""

from __future__ import annotations

import os
import random
import zlib

import pytest

from tandem.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_nearest_terms_of_any_word():
    rng = random.Random(4)
    terms = [("idiot", 1), ("idiom", 1), ("scum", 0), ("worthless", 2), ("worth", 1), ("ab", 1), ("a", 0), ("péché", 1)]
    matcher = T.Matcher(terms)
    words = ["", "xyz"] + [t for t, _ in terms]
    for _ in range(3000):
        w = list(rng.choice(terms)[0])
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(0, len(w))
            w[k : k + rng.randint(0, 1)] = rng.choice(["", "z", "i", "o", "é"])
        words.append("".join(w))
    for word in words:
        near = [(distance(word, t), t) for t, most in terms if distance(word, t) <= most]
        assert matcher.nearest(word) == (min(near)[::-1] if near else None), word


def test_context():
    found = [(0, 1.0), (3, 2.0), (40, 2.5), (41, 1.0), (90, 1.0)]
    assert T.highest_window(found, 25) == 3.5 and T.highest_window([], 25) == 0
    say = 'he said "you are an idiot" to the crowd and you are an idiot too'.split()
    assert T.quoted(say, 5) and not T.quoted(say, 13)
    model = T.Model(words={"idiot": 4.0, "worthless": 3.0}, fuzzy={"idiot": 1, "worthless": 2})
    s = T.Scorer(model)
    assert s.hits("You IDIOT!") == ([(1, 4.0)], 2)
    assert s.hits("an idi0t and a wrthles one")[0] == [(1, 4.0 * T.MISSPELT), (4, 3.0 * T.MISSPELT)]
    assert s.hits('the word "idiot" is')[0] == [(2, 4.0 * T.QUOTED)]
    assert s.hits("")[0] == [] and s.figures(None) == (0.0, 0.0, 0.0, 0.0)


def made(spark, n=400):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["ta", "lo", "mi", "ren", "su", "ke"]) for _ in range(rng.randint(1, 4)))
    bad = ["zargoth", "plimwick", "vexundra"]
    rows, labels = [], []
    for i in range(n):
        ws = [word() for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                b = rng.choice(bad)
                if i % 3 == 0 and rng.random() < 0.5:
                    k = rng.randrange(1, len(b))
                    b = b[:k] + b[k + 1 :]
                ws.insert(rng.randrange(len(ws)), b)
        rows.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_terms_are_learned_and_found_misspelled(spark):
    docs, labels, truth = made(spark)
    model = T.train(T.training_sample(docs, labels))
    assert {"zargoth", "plimwick", "vexundra"} <= set(model.words)
    got = T.score_documents(docs, labels).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in truth}
    wrong = [r["doc_id"] for r in got if r["held_out"] and r["predicted"] != truth[r["doc_id"]]]
    assert len(wrong) <= 0.03 * len(got) and all((r["score"] >= 0.7) == bool(r["predicted"]) for r in got)
    assert T.Scorer(model).score("ta lo zargth mi plimwck ren vexundr su") > 0.7


def test_held_out_labels_are_never_read(spark):
    docs, labels, _ = made(spark)
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, T.score_documents(docs, x).collect())) for x in (labels, other))
    assert a == b


def test_rows_with_a_defined_result(spark):
    docs, labels, _ = made(spark, 120)
    odd = [(None, "zargoth zargoth"), (900, None), (901, ""), (901, ""), (902, "ta " * 40000 + "zargoth plimwick vexundra")]
    extra = docs.union(spark.createDataFrame(odd, "doc_id long, text string")).selectExpr("*", "'x' AS score", "1 AS toxic")
    got = T.score_documents(extra, labels).collect()
    assert len(got) == 125 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[900]["score"] == by[901]["score"] < 0.7 and by[None]["held_out"] is False
    kept = T.without_toxic(extra, labels)
    assert kept.columns == extra.columns and kept.where("doc_id between 900 and 901").count() == 3
    none = T.score_documents(docs, labels.where("toxic = 0")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    assert T.score_documents(docs.where("false"), labels).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")
def test_accuracy_on_the_given_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = T.score_documents(docs, labels).where("held_out").join(labels, "doc_id")
    right = got.groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in right}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.02 * n[0, 0]
