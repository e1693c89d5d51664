"""Windows found by prefix tokens against every window tried at every word."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tandem.llm import decontaminate as D

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window):
    windows = set()
    for item, text in items:
        ws = words(text)
        windows |= {("" if item is None else str(item), tuple(ws[s : s + window])) for s in range(max(1, len(ws) - window + 1)) if ws}
    out = []
    for doc, text in docs:
        ws = words(text)
        met, covered = set(), set()
        for item, win in windows:
            for s in range(len(ws) - len(win) + 1):
                if tuple(ws[s : s + len(win)]) == win:
                    met.add(item)
                    covered.update(range(s, s + len(win)))
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((doc, len(ws), len(covered), len(met), digest, bool(covered) and 20 * len(covered) >= len(ws)))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(6)
    word = lambda: rng.choice(["a", "b", "c", "É", "9x", "d", "the", "Of"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 5, 9])))) for i in range(3, 16)]
    items += [(1, None), (2, "..."), (20, "q r s t u v"), (20, "q r s t u v w"), (None, "n u l l"), (21, "q r s t u v")]
    docs = []
    for i in range(60):
        parts = [rng.choice(items)[1] or "" if rng.random() < 0.4 else word() for _ in range(rng.randint(0, 12))]
        docs.append((i, rng.choice([" ", "-", "\n", ", "]).join(parts).swapcase()))
    long = "pad " * 30000 + "q r s t u v w x"
    docs += [(60, None), (61, ""), (62, long), (62, long), (None, "Q-R.S t u v"), (63, "\u007fé\u0080")]
    return docs, items


@pytest.mark.parametrize("blocks", [1000, 4])
@pytest.mark.parametrize("window", [5, 2])
def test_every_window_at_every_word(spark, window, blocks):
    docs, items = fixture()
    got = D.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), window, broadcast_windows=blocks)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, window)


def test_documents_that_stay_keep_their_columns(spark):
    docs, items = fixture()
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS + ", _h int, items string")
    kept = D.without_contaminated(table, spark.createDataFrame(items, ITEMS), window=5)
    assert kept.columns == table.columns
    clean = [r[0] for r in brute(docs, items, 5) if not r[5]]
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted(clean, key=str)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    none = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in D.contamination(docs, items.where("false")).collect()] == [(1, 2, 0, 0, none, False)]
    assert D.contamination(docs.where("false"), items).count() == 0


def test_no_python_in_the_plan(spark):
    plan = D.contamination(spark.createDataFrame([(1, "a b")], DOCS).coalesce(1), spark.createDataFrame([(1, "a b")], ITEMS))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", text)
