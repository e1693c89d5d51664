"""Repeated passages by sparse suffix arrays.

A passage is a run of words all of which lie in windows of ``least`` words that occur in two or more documents.

1. Of all suffixes only those at minimiser positions are kept: in every window of ``least`` words the position whose seed
   (``seed`` words from there) has the smallest hash. The choice depends on the words alone, so equal windows keep
   the same suffix, at the same place in them.
2. Suffixes whose seed lies in one document only are dropped: seeds are counted with a sum before the shuffle, and those of several
   documents set bits of two fields of a fixed size (``BITS``), one for all of them and one for the crowded ones. Bits that two
   seeds share let some more pass, which the next step drops.
3. The documents are read again; the suffixes that the field lets pass go with the words around their seed and are sorted, seed by seed. For each way a window can lie around
   a seed, all are sorted by the words they then begin with, and neighbours are compared; equal neighbours of
   different documents extend the match to the left and right as far as that window reaches.
4. Spans of a document that touch are one passage.

Seeds that more than ``crowd`` suffixes share are not handled in one task: their windows are hashed and summed like any
aggregate, with partial sums before the shuffle, and met again by a join that adaptive execution can split.

Words are parts between ASCII white space, A-Z in lower case. Defined results: a null text, or one of fewer than ``least``
words, has no passage; rows that repeat both id and text are one document, so they alone make no repeat, and their
passages are listed once; a null id takes part and is listed as null; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.words import WHITE, bytes_of, find_words, hash_words, in_pieces, table_of
from tandem.session import store

LEAST, SEED = 50, 25
CROWD = 100_000
#: Bytes of a word's hash that go along with a suffix.
WORD_BYTES = 3
#: Bits of a field of seeds, and bytes of text that are cut at a time.
BITS, CHUNK = 1 << 25, 1 << 22

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base to the powers 0 to n - 1, modulo 2**64."""
    p = _tables.get(base, np.ones(1, np.uint64))
    while len(p) < n:
        p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
    _tables[base] = p
    return p[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def spans_hashed(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of every run of ``length`` values along the last axis, the same for equal runs wherever they lie."""
    n = words.shape[-1]
    sums = np.zeros((*words.shape[:-1], n + 1), np.uint64)
    np.cumsum(words * _powers(_BASE, n), axis=-1, out=sums[..., 1:])
    runs = (sums[..., length:] - sums[..., : n + 1 - length]) * _powers(_INVERSE, n + 1 - length)
    return _mixed(runs)


def kept_positions(words: np.ndarray, least: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept suffixes and the hashes of their seeds; the first of equal hashes is the smallest."""
    if len(words) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    seeds = spans_hashed(words, seed)
    wide = least - seed + 1
    # Blocks keep the windows that are looked at together small, however long the text is.
    found = []
    for at in range(0, len(seeds) - wide + 1, 1 << 16):
        part = seeds[at : at + (1 << 16) + wide - 1]
        found.append(np.unique(np.lib.stride_tricks.sliding_window_view(part, wide).argmin(axis=1) + np.arange(len(part) - wide + 1)) + at)
    places = np.unique(np.concatenate(found))
    return places, seeds[places]


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc`` (a hash of id and text), ``has_id``, ``id``, ``text``; a row for each ``doc``."""
    rows = docs.select(
        F.xxhash64(F.lit(10), F.col(key).cast("string"), F.col(key).isNull(), F.col(text)).alias("doc"),
        F.col(key).isNotNull().alias("has_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"),
        F.col(text).alias("text"),
    )
    # Hashes are counted first, so that texts are shuffled only where rows repeat.
    again = store(rows.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc"), "repeated-rows")
    if not again.limit(1).count():
        return rows
    once = store(rows.join(again, "doc", "left_semi").dropDuplicates(["doc"]), "rows-once")
    return rows.join(again, "doc", "left_anti").unionByName(once)


def _kept(batch: pa.RecordBatch, least: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, words, places and seeds of each text that has some."""
    data, at = bytes_of(batch.column("text"))
    starts, ends, first = find_words(data, at, table_of(WHITE))
    words = hash_words(data, starts, ends)
    for i, (a, b) in enumerate(zip(first, first[1:], strict=False)):
        if b - a >= least:
            yield i, words[a:b], *kept_positions(words[a:b], least, seed)


def _suffixes(rows: DataFrame, least: int, seed: int) -> DataFrame:
    """``doc, seed`` of every kept suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, CHUNK):
            kept = [(i, seeds) for i, _, _, seeds in _kept(batch, least, seed)]
            if kept:
                docs = batch.column("doc").take(pa.array(np.repeat([i for i, _ in kept], [len(h) for _, h in kept])))
                yield pa.RecordBatch.from_arrays([docs, pa.array(np.concatenate([h for _, h in kept]).view(np.int64))], ["doc", "seed"])

    return rows.select("text", "doc").mapInArrow(run, "doc long, seed long")


def _field(seeds: DataFrame) -> np.ndarray:
    """The bits of the given seeds: ``BITS`` of them, however many there are."""
    place = F.pmod("seed", F.lit(BITS))
    bits = F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(seed, {BITS}) % 32 AS int))"))
    found = seeds.groupBy(F.floor(place / 32).cast("long").alias("at")).agg(bits.alias("bits")).toArrow()
    field = np.zeros(-(-BITS // 32), np.uint32)
    field[found.column("at").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return field


AROUND = "doc long, has_id boolean, id long, place int, seed long, n_left int, n_right int, words binary"


def _with_words(rows: DataFrame, shared: np.ndarray, crowded: np.ndarray, least: int, seed: int, crowds: bool) -> DataFrame:
    """The suffixes whose seed the field ``shared`` holds (and ``crowded``, or not), with the words before and after it,
    ``least - seed`` on both sides, and how many there are."""
    side = least - seed
    fields = rows.sparkSession.sparkContext.broadcast((shared, crowded))

    def has(field: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        at = seeds.view(np.int64) % BITS
        return (field[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)).astype(bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, crowded = fields.value
        offsets = np.concatenate([np.arange(-side, 0), np.arange(seed, seed + side)])
        for batch in in_pieces(batches, CHUNK):
            texts, columns = [], []
            for i, words, places, seeds in _kept(batch, least, seed):
                passing = has(shared, seeds) & (has(crowded, seeds) == crowds)
                places, seeds = places[passing], seeds[passing]
                if not len(places):
                    continue
                at = places[:, None] + offsets
                inside = (at >= 0) & (at < len(words))
                around = np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(0))
                raw = np.ascontiguousarray(around).view(np.uint8).reshape(len(places), 2 * side, 8)[:, :, :WORD_BYTES]
                texts.append(np.full(len(places), i))
                columns.append((places, seeds, inside[:, :side].sum(axis=1), inside[:, side:].sum(axis=1), raw.reshape(len(places), -1)))
            if not texts:
                continue
            which = pa.array(np.concatenate(texts))
            places, seeds, left, right, raw = (np.concatenate(c) for c in zip(*columns, strict=True))
            own = [batch.column(c).take(which) for c in ("doc", "has_id", "id")]
            width = 2 * side * WORD_BYTES
            flat = pa.Array.from_buffers(pa.binary(width), len(raw), [None, pa.py_buffer(np.ascontiguousarray(raw))]).cast(pa.binary())
            made = [pa.array(places.astype(np.int32)), pa.array(seeds.view(np.int64)), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), flat]
            yield pa.RecordBatch.from_arrays([*own, *made], [c.split()[0] for c in AROUND.split(", ")])

    return rows.select("text", "doc", "has_id", "id").mapInArrow(run, AROUND)


def _keys(batch: pd.DataFrame, side: int) -> np.ndarray:
    """For each row and each number of words o that a window takes from the left: the hash of those and the rest."""
    raw = np.frombuffer(b"".join(batch["words"]), np.uint8).reshape(len(batch), 2 * side, WORD_BYTES)
    words = np.zeros((len(batch), 2 * side), np.uint64)
    for b in range(WORD_BYTES):
        words |= raw[:, :, b].astype(np.uint64) << np.uint64(8 * b)
    return spans_hashed(_mixed(words + np.uint64(1)), side)[:, ::-1]  # column o begins side - o words in


SPANS = "doc long, has_id boolean, id long, start int, stop int, has_partner boolean, partner long"


def _matched(batch: pd.DataFrame, least: int, side: int) -> pd.DataFrame:
    """Spans of the rows of whole seeds, sorted and compared with their neighbours for each way a window can lie."""
    keys = _keys(batch, side)
    seeds, docs = batch["seed"].to_numpy(), batch["doc"].to_numpy()
    n_left, n_right = batch["n_left"].to_numpy(), batch["n_right"].to_numpy()
    first, last = np.full(len(batch), side + 1), np.full(len(batch), -1)
    partner = np.full(len(batch), -1)
    for o in range(side + 1):
        rows = np.flatnonzero((n_left >= o) & (n_right >= side - o))
        rows = rows[np.lexsort((docs[rows], keys[rows, o], seeds[rows]))]
        if len(rows) < 2:
            continue
        same = (seeds[rows][1:] == seeds[rows][:-1]) & (keys[rows, o][1:] == keys[rows, o][:-1])
        group = np.concatenate([[0], np.cumsum(~same)])
        begin = np.flatnonzero(np.concatenate([[True], ~same]))
        end = np.concatenate([begin[1:], [len(rows)]]) - 1
        lowest, highest = rows[begin][group], rows[end][group]  # rows of the group's first and last document
        shared = docs[lowest] != docs[highest]
        hit, other = rows[shared], np.where(docs[lowest] == docs[rows], highest, lowest)[shared]
        first[hit], last[hit] = np.minimum(first[hit], o), np.maximum(last[hit], o)
        partner[hit] = np.where(partner[hit] < 0, other, partner[hit])
    hit = np.flatnonzero(last >= 0)
    out, other = batch.iloc[hit], batch.iloc[partner[hit]]
    return pd.DataFrame(
        {
            "doc": out["doc"].to_numpy(),
            "has_id": out["has_id"].to_numpy(),
            "id": out["id"].to_numpy(),
            "start": (out["place"].to_numpy() - last[hit]).astype(np.int32),
            "stop": (out["place"].to_numpy() - first[hit] + least).astype(np.int32),
            "has_partner": other["has_id"].to_numpy(),
            "partner": other["id"].to_numpy(),
        }
    )


def _by_neighbours(around: DataFrame, least: int, side: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < 20_000:
                continue
            every = pd.concat(held, ignore_index=True)
            done = int((every["seed"] != every["seed"].iloc[-1]).sum())  # the last seed may go on in the next batch
            if done:
                yield _matched(every.iloc[:done].reset_index(drop=True), least, side)
            held, rows = [every.iloc[done:]], len(every) - done
        if rows:
            yield _matched(pd.concat(held, ignore_index=True), least, side)

    parts = max(1, int(around.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return around.repartition(parts, "seed").sortWithinPartitions("seed").mapInPandas(run, SPANS)


def _by_sums(around: DataFrame, least: int, side: int) -> DataFrame:
    """The same for crowded seeds: each window of each suffix as a row, summed and joined."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                keys = _keys(part, side)
                o = np.arange(side + 1)
                inside = (part["n_left"].to_numpy()[:, None] >= o) & (part["n_right"].to_numpy()[:, None] >= side - o)
                row, taken = np.nonzero(inside)
                out = part[["doc", "has_id", "id", "place", "seed"]].iloc[row].reset_index(drop=True)
                yield out.assign(o=taken.astype(np.int32), key=keys[row, taken].view(np.int64))

    rows = around.mapInPandas(run, "doc long, has_id boolean, id long, place int, seed long, o int, key long")
    rows = store(rows, "crowded-windows")
    who = F.struct("doc", "has_id", "id")
    shared = rows.groupBy("seed", "o", "key").agg(F.min(who).alias("lowest"), F.max(who).alias("highest"))
    # Stored, so that the join is of two plain tables and a key with very many rows can be split.
    shared = store(shared.where("lowest.doc <> highest.doc"), "crowded-shared")
    other = F.when(F.col("lowest.doc") == F.col("doc"), F.col("highest")).otherwise(F.col("lowest"))
    met = rows.join(shared, ["seed", "o", "key"]).withColumn("other", other).groupBy("doc", "has_id", "id", "place")
    met = met.agg(F.min("o").alias("low"), F.max("o").alias("high"), F.min_by("other", "o").alias("other"))
    return met.select(
        "doc",
        "has_id",
        "id",
        (F.col("place") - F.col("high")).alias("start"),
        (F.col("place") - F.col("low") + least).alias("stop"),
        F.col("other.has_id").alias("has_partner"),
        F.col("other.id").alias("partner"),
    )


def repeated_passages(
    docs: DataFrame, least: int = LEAST, seed: int = SEED, key: str = "doc_id", text: str = "text", crowd: int = CROWD
) -> DataFrame:
    """``doc_id, start_word, stop_word, n_words, partner_id``: a row for each passage of each document that has one.

    Words are counted from 0, ``stop_word`` is the first after the passage; ``partner_id`` is a document that shares words of it.
    """
    if not 0 < seed < least:
        raise ValueError("a seed is shorter than a passage")
    rows = _documents(docs, key, text)
    many = _suffixes(rows, least, seed).groupBy("seed").agg(F.count("*").alias("n"), F.min("doc").alias("a"), F.max("doc").alias("b"))
    many = store(many.where("a <> b").select("seed", "n"), "seeds")
    shared, crowded = _field(many), _field(many.where(F.col("n") > crowd))
    side = least - seed
    spans = _by_neighbours(_with_words(rows, shared, crowded, least, seed, crowds=False), least, side)
    if crowded.any():
        spans = spans.union(_by_sums(_with_words(rows, shared, crowded, least, seed, crowds=True), least, side))
    order = Window.partitionBy("doc").orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", (F.col("start") > F.coalesce(reached, F.lit(-1))).cast("int"))
    runs = marked.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    partner = F.min(F.struct((~F.col("has_partner")).alias("none"), "partner", "has_partner"))
    found = runs.groupBy("doc", "run").agg(
        F.first("has_id").alias("has_id"),
        F.first("id").alias("id"),
        F.min("start").alias("start_word"),
        F.max("stop").alias("stop_word"),
        partner.alias("p"),
    )
    return found.select(
        F.when(F.col("has_id"), F.col("id")).alias("doc_id"),
        "start_word",
        "stop_word",
        (F.col("stop_word") - F.col("start_word")).alias("n_words"),
        F.when(F.col("p.has_partner"), F.col("p.partner")).alias("partner_id"),
    )
