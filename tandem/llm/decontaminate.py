"""Benchmark decontamination: a prefix-filtered set join, by DataFrame functions alone.

A window is ``window`` consecutive words of an item, or the whole of a shorter item. A document holds a window only if
it holds every shingle of it, so one necessary token per window is enough to find all candidates: the prefix that an
exact containment leaves is the window's rarest shingle. Rarity is counted over all documents, for the
benchmark's shingles.

1. Count each benchmark shingle in the corpus: the documents' shingles, as hashes, meet the benchmark's and are
   summed before any shuffle.
2. Per window keep the rarest shingle and its place. The documents' shingles meet these alone.
3. Bounds: a shingle at word p that is the j-th of its window asks for a window from p - j, so j words must lie before
   it and enough after it. What remains is compared word by word with the window.

Documents pass unshuffled; only counts and verified hits are shuffled. The benchmark's side is broadcast in blocks of
about ``broadcast_windows`` windows (of at most ``window`` words each, so of a known size): a larger benchmark takes
more passes, not more memory. Which items hold a window is not sent along, since copies of items may make that a long list: a hit
carries the window's number, and the items meet the different numbers of a document afterwards.

Words: A-Z in lower case, then runs of digits, letters a-z and all characters from U+0080. Defined results: a null
or empty text has no words and is not contaminated; an item without words has no window; items that share an id count
once, and a null item id is written as an empty string; each repeated row of the documents gets its own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.session import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows that are sent to every task at a time; 200,000 of 13 words of 10 bytes make some 30 MB.
BROADCAST_WINDOWS = 200_000
#: Words in a token; windows with fewer words are a token of their own length.
SHINGLE = 3


def words_of(text: Column) -> Column:
    """The words of a text, none for null."""
    parts = F.split(F.translate(text, UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def _hash_at(words: str, at: str, n: int) -> Column:
    """The hash of the ``n`` words from place ``at``; the number takes part, so lengths don't mix."""
    return F.expr(f"xxhash64({n}, {', '.join(f'get({words}, {at} + {i})' for i in range(n))})")


def windows_of(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """``win, wid, n``: each different window once, two hashes as its number, and its words; and ``wid, item``, the items it is of."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = F.explode(F.transform(starts, lambda s: F.slice("w", s, window)))
    number = F.struct(F.xxhash64("win").alias("a"), F.xxhash64(F.lit(7), "win").alias("b"))
    windows = words.where(F.size("w") > 0).select("item", cut.alias("win")).withColumn("wid", number)
    return windows.select("win", "wid").distinct().withColumn("n", F.size("win")), windows.select("wid", "item").distinct()


def _tokens(words: DataFrame, size: int, kept: list[str]) -> DataFrame:
    """A row for each shingle of the documents: the kept columns, its place ``p`` and its hash."""
    places = F.when(F.size("_w") >= size, F.sequence(F.lit(0), F.size("_w") - size))
    return words.select(*kept, "_w", F.explode(places).alias("p")).withColumn("token", _hash_at("_w", "p", size))


def prefix_tokens(words: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """Per window its rarest shingle in the documents, ties by hash and place: ``win, token, j, wid, n``."""
    places = F.explode(F.sequence(F.lit(0), F.col("n") - size))
    shingles = windows.select("win", "wid", "n", places.alias("j")).withColumn("token", _hash_at("win", "j", size))
    known = shingles.select("token").distinct()
    counts = _tokens(words, size, []).select("token").join(F.broadcast(known), "token").groupBy("token").count()
    # A shingle that no document holds leads to no window, so the window has none.
    ranked = shingles.join(counts, "token", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    best = F.min_by(F.struct("token", "j", "wid", "n", "count"), F.struct("count", "token", "j"))
    return ranked.groupBy("win").agg(best.alias("b")).select("win", "b.*").where("count > 0").drop("count")


def occurrences(words: DataFrame, windows: DataFrame, size: int, kept: list[str]) -> DataFrame:
    """Verified occurrences of the windows: the kept columns, ``start``, ``n``, ``wid``."""
    met = _tokens(words, size, kept).join(F.broadcast(prefix_tokens(words, windows, size)), "token")
    start = F.col("p") - F.col("j")
    bounds = (start >= 0) & (start + F.col("n") <= F.size("_w"))
    exact = F.slice("_w", F.greatest(start, F.lit(0)) + 1, F.col("n")) == F.col("win")
    return met.where(bounds & exact).select(*kept, start.alias("start"), "n", "wid")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    share: int = 20,
    key: str = "doc_id",
    text: str = "text",
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every document.

    A word is hit inside any occurrence of a window; a document is contaminated if some are and they make at least
    one word in ``share``.
    """
    words, hits, named = _hits(docs, items, window, key, text, broadcast_windows)
    hits = store(hits, "benchmark-hits")
    of_doc = hits.select("_id", "_h", "wid").distinct().join(named, "wid").groupBy("_id", "_h").agg(F.collect_set("item").alias("items"))
    of_doc = of_doc.select(F.col("_id").alias("_i"), F.col("_h").alias("_t"), F.sort_array("items").alias("items"))
    rows = _summed(words, hits, share)
    joined = rows.join(of_doc, rows["_id"].eqNullSafe(of_doc["_i"]) & (rows["_h"] == of_doc["_t"]), "left")
    found = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
        "contaminated",
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    words, hits, _ = _hits(docs, items, window, key, text, BROADCAST_WINDOWS)
    # Stored first, so that Spark knows how few they are and need not shuffle the texts to take them out.
    bad = store(_summed(words, hits, share).where("contaminated").select("_id", "_h").distinct(), "contaminated")
    same = F.col(key).cast("long").eqNullSafe(bad["_id"]) & (_text_hash(text) == bad["_h"])
    return docs.join(bad, same, "left_anti")


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.lit(1), text)


def _hits(
    docs: DataFrame, items: DataFrame, window: int, key: str, text: str, most: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents as ``_id, _h, _w`` (id, hash of the text, words), all occurrences in them, and the windows' items."""
    windows, named = windows_of(items, window)
    words = docs.select(
        F.col(key).cast("long").alias("_id"), _text_hash(text).alias("_h"), words_of(F.col(text)).alias("_w")
    )
    # One row: how many windows, and which of the token lengths 1 to 3.
    n, sizes = windows.agg(F.count("*"), F.collect_set(F.least("n", F.lit(SHINGLE)))).first()
    blocks = max(1, -(-n // most))
    kept = ["_id", "_h"]
    found = docs.sparkSession.createDataFrame([], "_id long, _h long, start int, n int, wid struct<a:long,b:long>")
    for size in sorted(sizes):
        part = windows.where(F.least("n", F.lit(SHINGLE)) == size)
        for block in range(blocks):
            some = part if blocks == 1 else part.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == block)
            found = found.union(occurrences(words, some, size, kept))
    return words, found, named


def _summed(words: DataFrame, hits: DataFrame, share: int) -> DataFrame:
    """``_id, _h, n_words, n_hit, contaminated`` of each row. A document's spans meet in one row, which its own words bound."""
    of_doc = hits.groupBy("_id", "_h").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"))
    covered = F.expr(
        "aggregate(spans, named_struct('stop', 0, 'sum', 0L), (a, s) -> named_struct("
        "'stop', greatest(a.stop, s.start + s.n),"
        "'sum', a.sum + greatest(0, s.start + s.n - greatest(a.stop, s.start))), a -> a.sum)"
    )
    of_doc = of_doc.select(F.col("_id").alias("_i"), F.col("_h").alias("_t"), covered.alias("n_hit"))
    rows = words.select("_id", "_h", F.size("_w").cast("long").alias("n_words"))
    joined = rows.join(of_doc, rows["_id"].eqNullSafe(of_doc["_i"]) & (rows["_h"] == of_doc["_t"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select("_id", "_h", "n_words", n_hit.alias("n_hit"), ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))
