"""SimHash near-duplicates by anchor points.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a text's shingles. Anchors are the words of
a covering code: the perfect Hamming code of 31 bits, from which no word is more than 1 bit away. Two 31-bit
blocks of a fingerprint are covered, so two fingerprints within ``max_bits`` have a block in which they differ by
half of that at most. A fingerprint is sent home to the anchor within the covering radius of its block, and
visits every anchor within the radius plus that threshold; so of two linked fingerprints one meets the other at its
home. Only there are they compared, over all 64 bits.

Equal fingerprints are one row before anything is compared, however many documents share them, and the comparison is
a join whose condition holds the distance, so a crowded anchor is split by adaptive execution like any skewed key.

Defined results: a text without words has fingerprint 0 and is linked like any other; a null id takes part, but a
component is named by its smallest id that is not null, and by null if it has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.graph import components
from tandem.session import store

SEED = 42
BLOCKS, WIDTH = (0, 31), 31
RADIUS = 1


def shingle_hashes(text: str | None, words: int) -> list[int]:
    """Hashes of all shingles, repeats included; of the whole text if it has fewer words, none if it has none."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if len(parts) <= words:
        return [xxh64_intdigest(b" ".join(parts), SEED)] if parts else []
    line = b" ".join(parts)
    ends, at = [], -1
    for part in parts:
        at += len(part) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    return [xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts, ends[words - 1 :], strict=False)]


def fingerprint_of(hashes: list[int]) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text_hash, fp``: fp as a signed long; one row for each row of the documents."""
    rows = docs.select(
        F.col(key).isNotNull().alias("has_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = [fingerprint_of(shingle_hashes(t, words)) for t in batch["text"]]
            yield batch[["has_id", "id", "text_hash"]].assign(fp=np.array(fps, np.int64))

    found = rows.mapInPandas(run, "has_id boolean, id long, text_hash long, fp long")
    return found.select(F.when(F.col("has_id"), F.col("id")).alias("id"), "text_hash", "fp")


def _syndrome(block: Column) -> Column:
    """The exclusive or of the numbers, from 1, of the bits that are set: the bit that parts the word from the code."""
    out = F.lit(0)
    for k in range(5):
        mask = sum(1 << (i - 1) for i in range(1, WIDTH + 1) if i >> k & 1)
        out = out + F.shiftleft(F.bit_count(block.bitwiseAND(F.lit(mask).cast("long"))) % 2, k)
    return out.cast("int")


def with_anchors(fps: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Homes and visits: ``block, anchor, fp``. ``threshold`` is the distance in a block, 0 or 1."""
    whole = F.lit((1 << WIDTH) - 1).cast("long")
    blocks = [F.struct(F.lit(b).alias("block"), F.shiftrightunsigned("fp", at).bitwiseAND(whole).alias("word")) for b, at in enumerate(BLOCKS)]
    words = fps.select("fp", F.explode(F.array(*blocks)).alias("b")).select("fp", "b.*").withColumn("s", _syndrome(F.col("word")))
    homes = words.select("block", F.expr("if(s = 0, word, word ^ shiftleft(1L, s - 1))").alias("anchor"), "fp")
    if not threshold:
        return homes, homes
    # Two flips lead to the code if their numbers give the syndrome; a word of the code has no other within 2 bits.
    pairs = "filter(sequence(1, 31), i -> s <> 0 and i <> s and (i ^ s) > i)"
    far = words.select("block", "word", "fp", "s", F.explode(F.expr(pairs)).alias("i"))
    far = far.select("block", F.expr("word ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ s) - 1)").alias("anchor"), "fp")
    return homes, homes.union(far)


def links_of(fps: DataFrame, max_bits: int) -> DataFrame:
    """``u, v``: all pairs of the distinct fingerprints that differ in 1 to ``max_bits`` bits, each maybe twice."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the code covers distances of up to 3 bits")
    homes, visits = with_anchors(fps, max_bits // len(BLOCKS))
    h, v = homes.alias("h"), visits.alias("v")
    near = F.bit_count(F.col("h.fp").bitwiseXOR(F.col("v.fp"))) <= max_bits
    met = h.join(v, (F.col("h.block") == F.col("v.block")) & (F.col("h.anchor") == F.col("v.anchor")) & (F.col("h.fp") < F.col("v.fp")) & near)
    return met.select(F.col("h.fp").alias("u"), F.col("v.fp").alias("v"))


def _grouped(docs: DataFrame, words: int, max_bits: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents' ``id, text_hash, fp``, and each different ``fp`` with the ``root`` of its component.

    Both are stored, so that the joins on them, whose keys may be crowded, are of plain tables and can be split.
    """
    rows = store(fingerprints(docs, words, key, text), "simhash")
    prints = rows.groupBy("fp").agg(F.min("id").alias("id"))
    linked = components(links_of(prints.select("fp"), max_bits), "simhash-links")
    joined = prints.join(linked, prints["fp"] == linked["node"], "left")
    return rows, store(joined.select("fp", "id", F.coalesce("root", "fp").alias("root")), "simhash-roots")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``."""
    rows, roots = _grouped(docs, words, max_bits, key, text)
    names = store(roots.groupBy("root").agg(F.min("id").alias("component_id")), "simhash-names")
    named = store(roots.join(names, "root").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = 3, max_bits: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each component: the smallest id, then the smallest hash of the text."""
    rows, roots = _grouped(docs, words, max_bits, key, text)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    picked = rows.join(roots.select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("p")).select("p.id", "p.text_hash")
    picked = store(picked.distinct(), "simhash-kept").withColumnsRenamed({"id": "_pick_id", "text_hash": "_pick_hash"})
    same = F.col(key).cast("long").eqNullSafe(F.col("_pick_id")) & (F.xxhash64(text) == F.col("_pick_hash"))
    kept = docs.join(picked, same, "left_semi")
    copies = rows.groupBy("id", "text_hash").count().where("count > 1")
    # Rows that repeat both id and text can only be told apart by counting them.
    return kept.dropDuplicates([key, text]) if copies.limit(1).count() else kept
