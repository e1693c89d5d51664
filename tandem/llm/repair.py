"""Repair of conversation structure by one integer minimum.

Rows may be kept (K), given another role (R) or deleted (D), and empty rows may be inserted (I), until the roles read
``(s?(ua)+)?``. The edits of a conversation are a path through a directed graph without cycles: its nodes are a row and
what the roles so far allow, its arcs are what is done before and with a row. Every path has ONE weight, a big integer: the
high digits are its cost; below them each row has a field of fixed width with the letters of its arc, zeros at the
end where the arc has fewer. Letters have the order of their characters and no row's letters begin another's, so the
smaller integer is the cheaper path or, at equal cost, the one whose audit comes first. A plain minimum
decides, and the audit is read from the digits of the smallest weight.

Rows that must go (blank, or seen before) are the same for every path and come before any insert at their place, so they
have no field. Equal rows of a turn are one row with a number.

How it spreads: rows without texts are dealt by ranges of (conversation, turn) and checkpointed. A conversation inside a
range is settled there; one that crosses a border or has more than ``FIELDS`` fields is cut in blocks, each of which gives
the least weight for every pair of states at its ends, and a second search of the same kind over blocks (in groups of
blocks, if there are many) picks the pairs. Texts are shuffled once, by conversation, and hashed as they stream by in order.

Defined results: a null conversation id is a conversation, returned as null. Null turns come first. Rows of one turn go by
role, then by the MD5 of their text. A null role or text is one space. A role's initial is its first character; one that
is none of s, u and a can't be kept. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.ordered import in_order, partitions
from tandem.session import store

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
#: What the roles so far allow: nothing yet, after the system's, after a user's, after an assistant's.
NONE, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: After one more row of the role that may come next, user or assistant.
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {("s", NONE): SYSTEM, ("u", NONE): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER_BITS, INSERTS = 3, 2
FIELD = (INSERTS + 1) * LETTER_BITS
#: Rows of a block, and blocks of a group of blocks.
FIELDS = 256
#: A block has at most a weight for each pair of states.
RANK_BITS = 5

Arc = tuple[int, int, int, int]  # from, to, cost, code


def code_of(letters: str) -> int:
    code = 0
    for k in range(INSERTS + 1):
        code = code << LETTER_BITS | (LETTERS[letters[k]] if k < len(letters) else 0)
    return code


def letters_of(code: int) -> str:
    digits = [code >> LETTER_BITS * k & 7 for k in range(INSERTS, -1, -1)]
    return "".join(" DIKR"[d] for d in digits if d)


@lru_cache(maxsize=16)
def arcs_of(initial: str, cut_short: bool) -> tuple[Arc, ...]:
    """All that can be done before and with a row that need not go."""
    arcs = []
    for state in STATES:
        at, paid, letters = state, 0, ""
        for _ in range(INSERTS + 1):
            done = [(at, DELETE, "D"), (NEXT[at], REROLE + CUT_SHORT * cut_short, "R")]
            if (initial, at) in KEPT:
                done.append((KEPT[initial, at], KEEP + CUT_SHORT * cut_short, "K"))
            arcs += [(state, to, paid + cost, code_of(letters + letter)) for to, cost, letter in done]
            at, paid, letters = NEXT[at], paid + INSERT, letters + "I"
    return tuple(arcs)


#: What can be done after the last row.
ENDINGS = (
    (NONE, NONE, 0, 0),
    (ASSISTANT, ASSISTANT, 0, 0),
    (USER, ASSISTANT, INSERT, code_of("I")),
    (SYSTEM, ASSISTANT, 2 * INSERT, code_of("II")),
)


def least_weights(fields: list[tuple[Arc, ...]], bits: int, start: int) -> dict[int, int]:
    """The least weight of a path from ``start`` to each state that can be reached."""
    high = bits * len(fields)
    front = {start: 0}
    for i, arcs in enumerate(fields):
        low = high - bits * (i + 1)
        best: dict[int, int] = {}
        for a, b, cost, code in arcs:
            if a in front:
                weight = front[a] + (cost << high) + (code << low)
                if b not in best or weight < best[b]:
                    best[b] = weight
        front = best
    return front


def cost_and_codes(weight: int, n: int, bits: int) -> tuple[int, list[int]]:
    mask = (1 << bits) - 1
    return weight >> bits * n, [weight >> bits * (n - 1 - i) & mask for i in range(n)]


def ranked(weights: dict[tuple[int, int], int], n: int, bits: int) -> tuple[Arc, ...]:
    """One arc for each pair of states; its code is the rank of the low digits, which keeps their order."""
    low = (1 << bits * n) - 1
    ranks = {w: r for r, w in enumerate(sorted({w & low for w in weights.values()}))}
    return tuple((a, b, w >> bits * n, ranks[w & low]) for (a, b), w in weights.items())


def best_codes(fields: list[tuple[Arc, ...]], bits: int) -> tuple[int, list[int]]:
    """Cost and codes of the least path from nothing to an end. Long lists are searched in groups, then over the groups."""
    if len(fields) <= FIELDS:
        return cost_and_codes(min(least_weights(fields, bits, NONE).values()), len(fields), bits)
    groups = [fields[i : i + FIELDS] for i in range(0, len(fields), FIELDS)]
    found = [{(a, b): w for a in STATES for b, w in least_weights(g, bits, a).items()} for g in groups]
    arcs = [ranked(weights, len(g), bits) for g, weights in zip(groups, found, strict=True)]
    cost, picked = best_codes(arcs, RANK_BITS)
    codes, state = [], NONE
    for group, weights, of_group, pick in zip(groups, found, arcs, picked, strict=True):
        start, state = state, next(b for a, b, _, code in of_group if (a, code) == (state, pick))
        codes += cost_and_codes(weights[start, state], len(group), bits)[1]
    return cost, codes


class Block:
    """Consecutive rows of a conversation: fields, and the rows that must go before each and after the last."""

    def __init__(self) -> None:
        self.fields: list[tuple[Arc, ...]] = []
        self.gone: list[int] = [0]
        self.first, self.last, self.illegal = None, "", 0

    def add(self, initial: str, copies: int, judged: bool, cut_short: bool) -> None:
        """``judged``: the first copy need not go."""
        self.illegal += copies - 1
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if judged:
            self.fields.append(arcs_of(initial if initial in ("s", "u", "a") else "", cut_short))
            self.gone.append(0)
        self.gone[-1] += copies - judged

    def audit(self, codes: list[int]) -> str:
        parts = ["D" * self.gone[0]]
        for code, gone in zip(codes, self.gone[1:], strict=False):
            parts += [letters_of(code), "D" * gone]
        return "".join(parts) + "".join(map(letters_of, codes[len(self.fields) :]))

    def settled(self) -> tuple[int, str]:
        """Cost and audit of a whole conversation."""
        cost, codes = best_codes([*self.fields, ENDINGS], FIELD)
        return cost + DELETE * sum(self.gone), self.audit(codes)

    def open(self) -> tuple[tuple[Arc, ...], list[str]]:
        """Arcs for all pairs of states at the block's ends, and the audit of each."""
        n = len(self.fields)
        weights = {(a, b): w for a in STATES for b, w in least_weights(self.fields, FIELD, a).items()}
        audits = [self.audit(cost_and_codes(w, n, FIELD)[1]) for w in weights.values()]
        more = DELETE * sum(self.gone)
        return tuple((a, b, cost + more, rank) for a, b, cost, rank in ranked(weights, n, FIELD)), audits


BLOCKS = (
    "has_conv boolean, conv long, part int, block int, illegal long, first string, last string, cost long, audit string, "
    "arcs array<struct<a:int,b:int,cost:long,code:int>>, audits array<string>"
)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of one range of rows in order. The first and last conversation of the range may go on in another."""
    columns = [c.split()[0] for c in BLOCKS.split(", ")]
    part, number, out = TaskContext.get().partitionId(), 0, []
    now, block, is_open = None, Block(), True

    def ended(still_open: bool) -> None:
        nonlocal number, block
        cost, audit, arcs, audits = None, None, None, None
        if still_open:
            arcs, audits = block.open()
            arcs = [dict(zip(("a", "b", "cost", "code"), arc, strict=True)) for arc in arcs]
        else:
            cost, audit = block.settled()
        out.append((*now, part, number, block.illegal, block.first, block.last, cost, audit, arcs, audits))
        number, block = number + 1, Block()

    def frame() -> pd.DataFrame:
        made = pd.DataFrame(out, columns=columns).astype({"cost": "Int64"})
        out.clear()
        return made

    for batch in batches:
        for has_conv, conv, initial, copies, judged, cut_short in batch.itertuples(index=False):
            if (has_conv, conv) != now:
                if now is not None:
                    ended(is_open)
                    is_open = False
                now = (has_conv, conv)
            elif len(block.fields) >= FIELDS:
                is_open = True
                ended(True)
            block.add(initial, copies, judged, cut_short)
        if out:
            yield frame()
    if now is not None:
        ended(True)
        yield frame()


PICKS = "part int, block int, pick int, ending string, cost long, illegal long"


def _picked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For the blocks of each conversation, in order: which pair of states is taken; cost and border go to the first."""
    columns = [c.split()[0] for c in PICKS.split(", ")]
    now, places, fields, ends, out = None, [], [], [], []

    def ended() -> None:
        cost, codes = best_codes([*fields, ENDINGS], max(RANK_BITS, FIELD))
        crossed = sum(a + b not in ("su", "ua", "au") for (_, a), (b, _) in zip(ends, ends[1:], strict=False))
        state = NONE
        for k, (place, arcs, code) in enumerate(zip(places, fields, codes, strict=False)):
            pick = next(i for i, arc in enumerate(arcs) if (arc[0], arc[3]) == (state, code))
            state = arcs[pick][1]
            ending = letters_of(codes[-1]) if k == len(places) - 1 else ""
            out.append((*place, pick, ending, 0 if k else cost, 0 if k else crossed))
        places.clear(), fields.clear(), ends.clear()

    for batch in batches:
        for has_conv, conv, part, block, first, last, arcs in batch.itertuples(index=False):
            if (has_conv, conv) != now:
                if now is not None:
                    ended()
                now = (has_conv, conv)
            places.append((part, block))
            fields.append(tuple((x["a"], x["b"], x["cost"], x["code"]) for x in arcs))
            ends.append((first, last))
        if out:
            yield pd.DataFrame(out, columns=columns)
            out.clear()
    if now is not None:
        ended()
        yield pd.DataFrame(out, columns=columns)


FOUND = "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each conversation come after its audit; what the audit leaves of them is hashed as it comes."""
    names = {USER: "user", ASSISTANT: "assistant"}
    head, digest, state, at, empty, out = None, None, NONE, 0, True, []

    def put(line: str) -> None:
        nonlocal empty
        digest.update(line.encode("utf-8", "surrogatepass") if empty else b"\n" + line.encode("utf-8", "surrogatepass"))
        empty = False

    def inserted() -> None:
        nonlocal state, at
        while at < len(head.audit) and head.audit[at] == "I":
            state, at = NEXT[state], at + 1
            put(f"{names[state]}:")

    def ended() -> None:
        inserted()
        if at != len(head.audit):
            raise RuntimeError("an audit has more letters than its conversation has rows")
        out.append((head.has_conv, head.conv, *(getattr(head, c) for c in FOUND), digest.hexdigest()))

    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.kind == 0:
                if head is not None:
                    ended()
                head, digest, state, at, empty = row, hashlib.sha256(), NONE, 0, True
                continue
            for _ in range(int(row.copies)):
                inserted()
                letter, at = head.audit[at], at + 1
                if letter == "K":
                    state = KEPT[row.role[0], state]
                    put(f"{row.role}:{row.text}")
                elif letter == "R":
                    state = NEXT[state]
                    put(f"{names[state]}:{row.text}")
        if out:
            yield pd.DataFrame(out, columns=["has_conv", "conv", *FOUND, "repaired_sha256"])
            out.clear()
    if head is not None:
        ended()
        yield pd.DataFrame(out, columns=["has_conv", "conv", *FOUND, "repaired_sha256"])


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``has_conv, conv, turn, role, text, copies`` after the damage that the crc32 of id and turn decides."""
    spelt = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    kind = F.crc32(F.concat_ws(":", *spelt)) % 20
    rows = rows.select(
        F.col(conv).isNotNull().alias("has_conv"),
        F.coalesce(F.col(conv).cast("long"), F.lit(0)).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        kind.alias("damage"),
    )
    return rows.where("damage <> 0").select(
        "has_conv",
        "conv",
        "turn",
        F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("damage") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )




def _turns(rows: DataFrame) -> DataFrame:
    """A row without its text for each different row of a turn, with its number and what is wrong with it."""
    white = "\x20\x09\x0a\x0b\x0c\x0d"
    rest = F.rtrim("text", F.lit(white))
    turns = (
        rows.withColumns({"digest": F.md5("text"), "rest": rest})
        .withColumns({"is_blank": F.col("rest") == "", "cut_short": ~F.substring("rest", -1, 1).isin(".", "!", "?")})
        .groupBy("has_conv", "conv", "turn", "role", "digest", "is_blank", "cut_short")
        .agg(F.sum("copies").alias("copies"))
    )
    turns = store(turns, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"))
    same = ["has_conv", "conv", "role", "digest"]
    again = turns.groupBy(*same).agg(F.min(place).alias("seen"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Stored, so that the join is of two plain tables and a row said very often can be split.
    marked = turns.join(store(again, "turns-again"), same, "left")
    late = F.coalesce(place > F.col("seen"), F.lit(False))
    return marked.withColumn("judged", ~F.col("is_blank") & ~late)


ORDER = "has_conv", "conv", "turn", "role", "digest"


def repair(rows: DataFrame) -> DataFrame:
    """The contract's row for each conversation that has rows in ``rows`` (as ``damaged`` gives them)."""
    turns = in_order(_turns(rows), *ORDER)
    parts = partitions(rows)
    who = ["has_conv", "conv"]
    counts = turns.groupBy(*who).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("is_blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("is_blank"), 0).otherwise(F.col("copies") - F.col("judged").cast("long"))).alias("duplicate"),
        F.sum((F.col("judged") & F.col("cut_short")).cast("long")).alias("truncated"),
    )
    fields = turns.select(*who, F.substring("role", 1, 1).alias("initial"), "copies", "judged", "cut_short")
    blocks = store(fields.mapInPandas(_blocks, BLOCKS), "conversation-blocks")
    open_blocks = blocks.where("arcs IS NOT NULL")
    places = open_blocks.select(*who, "part", "block", "first", "last", "arcs")
    picks = places.repartition(parts, *who).sortWithinPartitions(*who, "part", "block").mapInPandas(_picked, PICKS)
    opened = open_blocks.drop("cost", "audit", "arcs", "illegal").join(picks, ["part", "block"])
    inner = open_blocks.select(*who, "part", "block", F.lit(0).cast("long").alias("cost"), "illegal", F.lit("").alias("piece"))
    pieces = blocks.where("arcs IS NULL").select(*who, "part", "block", "cost", "illegal", F.col("audit").alias("piece"))
    pieces = pieces.unionByName(inner).unionByName(
        opened.select(*who, "part", "block", "cost", "illegal", F.concat(F.get("audits", F.col("pick")), "ending").alias("piece"))
    )
    audits = pieces.groupBy(*who).agg(
        F.sum("cost").alias("cost"),
        F.sum("illegal").alias("illegal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "block", "piece"))), lambda p: p["piece"]), "").alias("audit"),
    )
    return counts.join(audits, who).select(*who, *FOUND)


def repaired_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row for each conversation of ``rows``, damaged and repaired: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256``. A conversation that the damage leaves no row has zeros, no audit and the hash of nothing."""
    after = damaged(rows, conv, turn, role, text)
    found = repair(after)
    who = ["has_conv", "conv"]
    every = rows.select(F.col(conv).isNotNull().alias("has_conv"), F.coalesce(F.col(conv).cast("long"), F.lit(0)).alias("conv"))
    zeros = {c: F.coalesce(c, F.lit("") if c == "audit" else F.lit(0).cast("long")) for c in FOUND}
    heads = every.distinct().join(found, who, "left").withColumns(zeros)
    nothing = {"turn": "long", "role": "string", "text": "string", "digest": "string", "copies": "long"}
    heads = heads.withColumn("kind", F.lit(0)).withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    lines = after.withColumns({"kind": F.lit(1), "digest": F.md5("text")})
    lines = lines.withColumns({c: F.lit("") if c == "audit" else F.lit(0).cast("long") for c in FOUND})
    stream = heads.unionByName(lines).withColumn("copies", F.coalesce("copies", F.lit(0)).cast("long"))
    stream = stream.repartition(partitions(rows), *who).sortWithinPartitions(*who, "kind", "turn", "role", "digest").drop("turn", "digest")
    schema = "has_conv boolean, conv long, " + ", ".join(f"{c} {'string' if c == 'audit' else 'long'}" for c in FOUND)
    done = stream.mapInPandas(_hashed, f"{schema}, repaired_sha256 string")
    return done.select(F.when(F.col("has_conv"), F.col("conv")).alias("conv_id"), *FOUND, "repaired_sha256")
