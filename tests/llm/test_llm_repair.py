"""Conversation repair against an exhaustive search, a plain search over strings, and the SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tandem.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def after_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def judged(kept):
    seen, out = set(), []
    for _, role, text in kept:
        rest = text.strip(WHITE)
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def every_repair(rows):
    """The least of all results of all edits, with one or two inserts in a row."""
    most = 2 if len(rows) < 3 else 1

    def go(i, inserted, cost, audit, lines):
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", "".join(x[:1] or "-" for x in lines)):
                yield cost, audit, lines
        else:
            role, text, fault = rows[i]
            yield from go(i + 1, 0, cost + 3, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                yield from go(i + 1, 0, cost + more, audit + "K", [*lines, f"{role}:{text}" if role else f"-{text}"])
                for new in ("user", "assistant"):
                    yield from go(i + 1, 0, cost + more + 2, audit + "R", [*lines, f"{new}:{text}"])
        if inserted < most:
            for new in ("user", "assistant"):
                yield from go(i, inserted + 1, cost + 2, audit + "I", [*lines, f"{new}:"])

    cost, audit, lines = min(go(0, 0, 0, "", []), key=lambda x: x[:2])
    return cost, audit, "\n".join(lines)


def plain_search(rows):
    """The least (cost, audit) by row and state, as strings."""
    front = {"": (0, "")}
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    insert = lambda front: {
        k: min(v[k] for v in tries if k in v)
        for tries in [[front, {step[s]: (c + 2, a + "I") for s, (c, a) in sorted(front.items(), key=lambda x: x[1], reverse=True)}]]
        for k in {*tries[0], *tries[1]}
    }
    for role, _, fault in rows:
        front, best = insert(insert(front)), {}
        for s, (c, a) in front.items():
            done = [(s, c + 3, a + "D")]
            if fault not in ("blank", "duplicate"):
                more, first = fault == "truncated", role[:1]
                done.append((step[s], c + 2 + more, a + "R"))
                if first == step[s] or (first, s) == ("s", ""):
                    done.append((first, c + more, a + "K"))
            for to, cost, audit in done:
                best[to] = min(best.get(to, (cost, audit)), (cost, audit))
        front = best
    front = insert(insert(front))
    return min(front[s] for s in ("", "a") if s in front)


def expected(rows, search=every_repair):
    out = {}
    for conv, kept in after_damage(rows).items():
        found = judged(kept)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = lambda fault, found=found: sum(f == fault for _, _, f in found)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:], strict=False))
        cost, audit, *text = search(found)
        digest = hashlib.sha256(text[0].encode()).hexdigest() if text else None
        out[conv] = (gaps, n("blank"), n("duplicate"), n("truncated"), illegal, cost, audit, digest)
    return out


def found_of(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_small_conversations_against_all_edits(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 3)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Hello.", "Yes", "", None, "Again!", "é?", " \t", "No. ", "so\x0b"])
            rows.append((conv, rng.choice([turn, turn, turn, 2 * turn, 0, None]), role, text))
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (-4, -(2**61), "user", "a"), (-4, 2**61, "user", "a")]
    found = found_of(repair.repaired_conversations(spark.createDataFrame(rows, SCHEMA)))
    assert found == expected(rows)
    assert {a for v in found.values() for a in v[6]} == set("DIKR")


@pytest.mark.parametrize("parts", ["1", "7"])
def test_long_conversations_are_cut_in_blocks(spark, monkeypatch, parts):
    monkeypatch.setattr(repair, "FIELDS", 5)  # of one block, and blocks of one group
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "tool"]), f"{t}{rng.choice(['.', '', '!'])}") for t in range(400)]
    rows += [(2, t, "tool", f"t {t}.") for t in range(90)]  # paths that never meet
    rows += [(3, t, "user", "Always the same.") for t in range(90)] + [(4, 0, "system", "S.")]
    rows += [(5, None, "user", "Equal rows.")] * 50
    try:
        found = found_of(repair.repaired_conversations(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {k: v[:7] for k, v in found.items()} == {k: v[:7] for k, v in expected(rows, plain_search).items()}
    small = [r for r in rows if r[0] in (4, 5)]
    assert found_of(repair.repaired_conversations(spark.createDataFrame(small[:1], SCHEMA)))[4] == expected(small[:1])[4]


def test_weights_of_groups_are_those_of_one_search(monkeypatch):
    rng = random.Random(3)
    for n in (1, 17, 120):
        rows = [(rng.choice("suax"), rng.random() < 0.5) for _ in range(n)]
        fields = [*(repair.arcs_of(i if i in "sua" else "", c) for i, c in rows), repair.ENDINGS]
        monkeypatch.setattr(repair, "FIELDS", 256)
        whole = repair.best_codes(fields, repair.FIELD)
        monkeypatch.setattr(repair, "FIELDS", 3)
        assert repair.best_codes(fields, repair.FIELD) == whole
        plain = plain_search([({"s": "system", "u": "user", "a": "assistant"}.get(i, "x"), "", "truncated" if c else "") for i, c in rows])
        assert (whole[0], "".join(map(repair.letters_of, whole[1]))) == plain


def test_dropped_empty_and_extra_columns(spark):
    gone = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(gone, SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    found = found_of(repair.repaired_conversations(df))
    assert found == {c: (0, 0, 0, 0, 0, 0, "", nothing) for c, *_ in gone}
    clashing = spark.createDataFrame([(7, 1, "user", "a.", 1, "x", 3)], f"{SCHEMA}, copies int, audit string, kind int")
    result = repair.repaired_conversations(clashing)
    assert found_of(result) == expected([(7, 1, "user", "a.")]) and len(result.columns) == 9
    assert repair.repaired_conversations(df.where("false")).count() == 0
    long_text = "w " * 400_000 + "."
    assert found_of(repair.repaired_conversations(spark.createDataFrame([(7, 1, "user", long_text)], SCHEMA))) == expected([(7, 1, "user", long_text)])
