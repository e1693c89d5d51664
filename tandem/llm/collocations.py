"""Phrase collocations from count streams in prefix and in suffix order.

Counts of words, pairs and triples are streams of sorted rows. In prefix order (by first, second, third word; shorter before
longer) the count of every first part of a phrase stands before the phrase, and a phrase's extensions to the right
stand behind it; in suffix order (by last, middle, first word) the same holds for last parts and extensions to the left. So
one pass in lockstep over each order finds all left, right and extension counts: the streams of the three lengths
are merged by the sort, nothing is looked up. A stream is dealt by ranges and checkpointed; the last counts of a range
are handed to the next, and the extensions with which a range begins to the phrase before it (one value a range).

Counting. A task cuts its texts into words at once for some megabytes, sorts the numbers of its words, pairs and triples and
sends a sum for each different one; the sums are added by a grouping. A phrase that occurs ``least`` times has
only parts that do, so triples are sent only where both pairs may be frequent: a bit field of a fixed size
(``BITS``), made from all frequent pairs, says so. It may let too many pass, never too few; the counts stay exact.

Defined results: a null text is empty, a null language ``und``; languages are told apart by their bytes. A row
that is repeated counts each time. An empty table, or one without a frequent phrase, gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.ordered import in_order
from tandem.llm.words import as_words, bytes_of, find_words, hash_column, hash_words, in_pieces, mixed, table_of
from tandem.session import store

#: Fixed by the contract: what ends a piece, and what parts its words.
BREAKS = tuple(b".,;:!?\x0a\x0b\x0c\x0d")
SPACES = tuple(b" \t")
#: Bytes of text that a task sorts at a time.
CHUNK = 1 << 22
#: Bits of the field of pairs.
BITS = 1 << 25
#: Rows that a task sends at a time.
SENT = 1 << 17

SCALE = 1_000_000
GAP = pa.scalar(" ", pa.large_string())


class Words:
    """The words of some texts as numbers: ``word`` is the place in ``spelt`` (in the order of bytes), ``typ`` that of the
    language and word in ``type_lang`` and ``type_word``; ``joined[i]`` says whether word i + 1 follows in the same piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array) -> None:
        data, at = bytes_of(texts)
        ends_piece = table_of(BREAKS)
        parts = ends_piece | table_of(SPACES)
        starts, ends, first = find_words(data, at, parts)
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        piece = np.searchsorted(np.flatnonzero(ends_piece[data]), starts)
        self.joined = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        coded = as_words(data, parts, starts, ends).dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary.cast(pa.large_binary())).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.spelt = coded.dictionary.take(pa.array(order))
        known = langs.dictionary_encode()
        self.langs = known.dictionary
        lang = known.indices.to_numpy()[text].astype(np.int64)
        words = max(1, len(order))
        types, self.typ, self.counts = np.unique(
            lang * words + place[coded.indices.to_numpy()], return_inverse=True, return_counts=True
        )
        self.type_lang, self.type_word = types // words, types % words

    def spelling(self, types: np.ndarray) -> pa.Array:
        return self.spelt.take(pa.array(self.type_word[types]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where pairs begin; first types, and second types of the different ones; which of them each is; how often."""
        at = np.flatnonzero(self.joined)
        n = max(1, len(self.type_word))
        keys, which, counts = np.unique(self.typ[at] * n + self.typ[at + 1], return_inverse=True, return_counts=True)
        return at, keys, which, counts


def _sent(langs: pa.Array, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(counts), SENT):
        part = slice(a, a + SENT)
        yield pa.RecordBatch.from_arrays(
            [langs[part].cast(pa.string()), phrases[part].cast(pa.string()), pa.array(counts[part].astype(np.int64))], ["lang", "phrase", "n"]
        )


COUNTS = "lang string, phrase string, n long"


def _words_and_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of all words (as the empty phrase), of each word and of each pair."""
    for batch in in_pieces(batches, CHUNK):
        words = Words(batch.column(1), batch.column(0))
        if not len(words.typ):
            continue
        total = np.bincount(words.type_lang, words.counts, len(words.langs)).astype(np.int64)
        yield from _sent(words.langs, pa.array([""] * len(total), pa.large_string()), total)
        yield from _sent(words.langs.take(pa.array(words.type_lang)), words.spelt.take(pa.array(words.type_word)), words.counts)
        _, keys, _, counts = words.pairs()
        a, b = keys // len(words.type_word), keys % len(words.type_word)
        phrases = pc.binary_join_element_wise(words.spelling(a), words.spelling(b), GAP)
        yield from _sent(words.langs.take(pa.array(words.type_lang[a])), phrases, counts)


def _bit_of(langs: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """The place of a pair in the field, from the hashes of its language and words."""
    return (mixed(langs + a * np.uint64(0xE7037ED1A0B428DB) + mixed(b)) % np.uint64(bits)).astype(np.int64)


def _field(pairs: DataFrame, bits: int) -> np.ndarray:
    """The bits of all pairs ``lang, a, b``; of a fixed size, however many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bit_of(*(hash_column(batch.column(i)) for i in range(3)), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(at & 31)], ["at", "bit"])

    marked = pairs.select("lang", "a", "b").mapInArrow(run, "at long, bit long")
    found = marked.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit AS int))")).alias("bits")).toArrow()
    field = np.zeros(-(-bits // 32), np.uint32)
    field[found.column("at").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return field


def _triples(docs: DataFrame, field: np.ndarray, bits: int) -> DataFrame:
    """Sums of each triple both of whose pairs are in the field."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in in_pieces(batches, CHUNK):
            words = Words(batch.column(1), batch.column(0))
            if not len(words.typ):
                continue
            at, keys, which, _ = words.pairs()
            n = len(words.type_word)
            a, b = keys // n, keys % n
            lang, spelt = hash_column(words.langs), hash_column(words.spelt)
            bit = _bit_of(lang[words.type_lang[a]], spelt[words.type_word[a]], spelt[words.type_word[b]], bits)
            kept = (field[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1)).astype(bool)[which]
            two = np.flatnonzero(kept[:-1] & kept[1:] & (at[1:] == at[:-1] + 1))  # pairs that follow each other
            triples, counts = np.unique(which[two] * n + words.typ[at[two] + 2], return_counts=True)
            pair, c = triples // n, triples % n
            phrases = pc.binary_join_element_wise(*map(words.spelling, (a[pair], b[pair], c)), GAP)
            yield from _sent(words.langs.take(pa.array(words.type_lang[c])), phrases, counts)

    return docs.mapInArrow(run, COUNTS)


def _summed(sums: DataFrame) -> DataFrame:
    """Tasks have added up what they could, so rows are dealt out before anything is added again."""
    return sums.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``lang, words, size, n`` of all phrases of 1 to 3 words that occur ``least`` times, and ``lang, n`` of all words."""
    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    sums = _summed(rows.mapInArrow(_words_and_pairs, COUNTS))
    short = store(sums.where((F.col("n") >= least) | (F.col("phrase") == "")), "phrases")
    pairs = short.withColumn("words", F.split("phrase", " ")).where("size(words) = 2")
    field = _field(pairs.selectExpr("lang", "words[0] AS a", "words[1] AS b"), BITS)
    longer = _summed(_triples(rows, field, BITS)).where(F.col("n") >= least)
    every = short.where("phrase <> ''").unionByName(longer).withColumn("words", F.split("phrase", " "))
    return every.selectExpr("lang", "words", "size(words) AS size", "n"), short.where("phrase = ''").select("lang", "n")


def _last(marked: np.ndarray, n: np.ndarray, before: int) -> np.ndarray:
    """For each row the count of the last marked row up to it; ``before`` if there is none."""
    at = np.maximum.accumulate(np.where(marked, np.arange(len(n)), -1))
    return np.where(at < 0, before, n[np.maximum(at, 0)])


def _border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a range tells its neighbours: its last counts of one and of two words, the most frequent triple before its first
    shorter phrase, and whether it has one."""
    one, two, lead, has_short = -1, -1, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        size, n = (batch.column(c).to_numpy() for c in ("size", "n"))
        short = size < 3
        if not has_short:
            until = int(np.argmax(short)) if short.any() else len(n)
            lead = max(lead, int(n[:until].max(initial=0)))
        has_short |= bool(short.any())
        one, two = (int(_last(size == k, n, x)[-1]) for k, x in ((1, one), (2, two)))
    row = [TaskContext.get().partitionId(), one, two, lead, has_short]
    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["part", "one", "two", "lead", "has_short"])


def _handed_on(rows: list) -> dict[int, tuple[int, int, int]]:
    """For each range: the counts of one and two words before it, and the most frequent triple with which later ones go on."""
    one, two, out = 0, 0, {}
    for r in rows:
        out[r.part] = (one, two)
        one, two = (r.one if r.one >= 0 else one), (r.two if r.two >= 0 else two)
    after = 0
    for r in reversed(rows):
        out[r.part] = (*out[r.part], after)
        after = r.lead if r.has_short else max(after, r.lead)
    return out


def with_parts(stream: DataFrame, names: tuple[str, str, str], backwards: bool = False) -> DataFrame:
    """Adds to each phrase the counts of its first one and two words (its last ones ``backwards``) and the largest of its
    extensions at the other end, in columns ``names``. The stream holds all parts of its phrases."""
    one_name, two_name, longest_name = names
    words = F.reverse("words") if backwards else F.col("words")
    keys = [f"_k{i}" for i in range(3)]
    own = stream.columns
    rows = in_order(stream.select(*own, *[F.get(words, F.lit(i)).alias(k) for i, k in enumerate(keys)]), "lang", *keys)
    counts = rows.select("size", "n").mapInArrow(_border, "part long, one long, two long, lead long, has_short boolean")
    handed = _handed_on(sorted(counts.collect(), key=lambda r: r.part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, after = handed.get(TaskContext.get().partitionId(), (0, 0, 0))
        held, top = None, 0

        def added(batch: pa.RecordBatch, *columns: np.ndarray) -> pa.RecordBatch:
            arrays = [*batch.columns, *(pa.array(c.astype(np.int64)) for c in columns)]
            return pa.RecordBatch.from_arrays(arrays, [*own, *names])

        for batch in batches:
            if not batch.num_rows:
                continue
            size, n = (batch.column(c).to_numpy() for c in ("size", "n"))
            ones, twos = _last(size == 1, n, one), _last(size == 2, n, two)
            one, two = int(ones[-1]), int(twos[-1])
            short = size < 3
            group = np.cumsum(short)
            tops = np.zeros(group[-1] + 1, np.int64)
            np.maximum.at(tops, group, np.where(short, 0, n))
            top = max(top, int(tops[0]))
            longest = np.where(size == 2, tops[group], 0)
            if not short.any():
                yield added(batch, ones, twos, longest)
                continue
            if held is not None:
                yield added(held[0], held[1], held[2], np.array([top]))
            last = int(np.flatnonzero(short)[-1])  # its extensions may go on in the next batch
            held, top = (batch.slice(last, 1), ones[last : last + 1], twos[last : last + 1]), int(tops[-1])
            rest = np.arange(batch.num_rows) != last
            yield added(batch.filter(pa.array(rest)), ones[rest], twos[rest], longest[rest])
        if held is not None:
            yield added(held[0], held[1], held[2], np.array([max(top, after)]))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    return rows.select(*own).mapInArrow(run, f"{schema}, {one_name} long, {two_name} long, {longest_name} long")


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """``floor(SCALE * a * a / (left * right))`` of counts up to 10**15, exactly."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    squared = F.lit(SCALE).cast("decimal(7,0)") * a * a
    return F.call_function("div", squared, left * right)


def collocations(
    docs: DataFrame, least: int = 10, share: int = 50, first: int = 2000, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The ``first`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Phrases of 2 or 3 words that occur ``least`` times, but for those of which a longer one has ``share`` percent.
    """
    phrases, totals = frequent_phrases(docs, least, text, lang)
    both = with_parts(with_parts(phrases, ("first", "first_two", "longer_right")), ("last", "last_two", "longer_left"), backwards=True)
    longer = F.when(F.col("size") == 2, F.greatest("longer_left", "longer_right")).otherwise(0)
    kept = both.where(F.col("size") > 1).where(100 * longer < share * F.col("n"))
    cut = lambda k, left, right: F.struct(
        cut_score(F.col("n"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r")
    )
    after_one, after_two = cut(1, "first", "last_two"), cut(2, "first_two", "last")
    lowest = F.when(F.col("size") == 2, cut(1, "first", "last")).otherwise(F.least(after_one, after_two))
    scored = kept.select("lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), lowest.alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
