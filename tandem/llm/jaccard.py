"""N-gram Jaccard join by an R-tree over count vectors.

A document's set holds the hashes of its different shingles; equal sets are one class, and only classes are joined. Shingles
are dealt to ``GROUPS`` groups by their hash, and the counts of the groups are a point. Two sets share at most the
sum of the smaller count of each coordinate, so pairs whose sum is too small for the wanted similarity cannot be linked.
Points are indexed as in an R-tree: leaves of ``LEAF`` points, packed by size, hold nodes of ``NODE`` points, tiled by
coordinates; the upper corners of two nodes bound the overlap of any of their points, then the points' own coordinates do, and what
survives is verified on the whole sets.

Cells. Two linked sets also share one of their first shingles (as many as a linked set may lack, and one) in any order that
holds for all documents; a cell is such a shingle with all its classes, and the tree is built in cells. The order puts
shingles of rare words first, by the counts of the most frequent words, and those shingles last that occur most themselves (``HEAVY``
of both, counted over all documents), so a passage that many documents share makes no crowded cell, unless a document has little
else. Cells with the same classes are one. The order decides only how much work there is: any counts give the same links.

A pair that meets in several cells is a candidate in the first of them only, which each point knows from the list of its cells.

Groups of near copies. First each point is compared with the next ones of its node only; what these links join has one label, and
points with one label are not compared again, so a group of thousands costs about as many verified pairs as it has members.
Leaves are met pair by pair in different tasks, so a crowded cell is spread.

Defined results: a null text, or one without words, has an empty set, links with nothing and is its own component. A null
id takes part; a component is named by its smallest id that is not null, and by null if it has none. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.graph import united
from tandem.llm.ordered import partitions
from tandem.llm.words import WHITE, bytes_of, find_words, hash_shingles, hash_words, in_pieces, mixed, table_of
from tandem.session import store

GROUPS = 256
NODE, LEAF = 16, 512
#: Words and shingles whose counts make the order of a set.
HEAVY = 200_000
#: Bytes of text that are cut at a time; points and pairs that are compared at a time.
CHUNK, POINTS, PAIRS = 1 << 23, 20_000, 1 << 15
#: Points after it in its node with which a point is compared first.
AHEAD = 2
#: Bytes of a count: one, but for the longest texts.
_KINDS = "<u1", "<u2", "<u4"
#: Bits that stand for the texts of a round; of a fixed size, however many there are.
BITS = 1 << 22


def all_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and the number of the first word of each text (and one past the last)."""
    data, at = bytes_of(texts)
    starts, ends, first = find_words(data, at, table_of(WHITE))
    return hash_words(data, starts, ends), first


def distinct_shingles(
    words: np.ndarray, first: np.ndarray, size: int, ranks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the set of each text begins (and the last ends), the hashes of all sets, sorted text by text, and the sums of the ranks
    of their words."""
    text, hashes = hash_shingles(words, first, size)
    bounds = np.searchsorted(text, np.arange(len(first)))
    sums = np.zeros(len(hashes), np.int64)
    if ranks is not None:
        counts = np.minimum(np.diff(first), size)[text]
        at = first[:-1][text] + np.arange(len(text)) - bounds[text]
        total = np.concatenate([[0], np.cumsum(ranks)])
        sums = total[at + counts] - total[at]
    for a, b in zip(bounds, bounds[1:], strict=False):
        order = np.argsort(hashes[a:b])
        hashes[a:b], sums[a:b] = hashes[a:b][order], sums[a:b][order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return np.searchsorted(text[new], np.arange(len(first))), hashes[new], sums[new]


def sets_of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_shingles(*all_words(texts), size)[:2]


def class_of(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """64 bits for each set, the same for equal sets; 0 for the empty one."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes), dtype=np.uint64)])
    count = np.diff(bounds).astype(np.uint64)
    out = mixed(sums[bounds[1:]] - sums[bounds[:-1]] + count * np.uint64(0xA0761D6478BD642F))
    return np.where(count > 0, out, 0).view(np.int64)


def needed(count: int, percent: int) -> int:
    """How many of a set's first shingles must hold one that a linked set has too."""
    return count - -(-percent * count // 100) + 1


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


class Order:
    """Ranks of words and shingles by their counts; 0 for those that are not among the most frequent."""

    def __init__(self, words: dict[str, np.ndarray], shingles: dict[str, np.ndarray]) -> None:
        self.words, self.shingles = words, shingles

    @staticmethod
    def _counts(table: dict[str, np.ndarray], hashes: np.ndarray) -> np.ndarray:
        if not len(table["token"]):
            return np.zeros(len(hashes), np.int64)
        out = np.zeros(len(hashes), np.int64)
        some = np.flatnonzero(table["seen"][hashes >> np.uint64(42)])  # most are none of the table's
        at = np.minimum(np.searchsorted(table["token"], hashes[some]), len(table["token"]) - 1)
        out[some] = np.where(table["token"][at] == hashes[some], table["n"][at], 0)
        return out

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        return np.frexp(self._counts(self.words, hashes).astype(float))[1].astype(np.int64)  # the bits of the count

    def of_shingles(self, hashes: np.ndarray, word_ranks: np.ndarray) -> np.ndarray:
        counts = self._counts(self.shingles, hashes)
        return np.where(counts > 0, counts + (1 << 40), word_ranks)


def _most_frequent(rows: DataFrame, words: int) -> Order:
    """The words and shingles that come several times in a task's chunk, summed over all: the most frequent of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, CHUNK):
            hashes, first = all_words(batch.column(0))
            least = max(2, len(hashes) >> 17)
            for kind, (values, counts) in enumerate(
                (np.unique(hashes, return_counts=True), np.unique(distinct_shingles(hashes, first, words)[1], return_counts=True))
            ):
                often = counts >= (2 if kind else least)
                columns = [pa.array(np.full(often.sum(), kind)), _longs(values[often]), pa.array(counts[often].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "token", "n"])

    sums = rows.select("text").mapInArrow(run, "kind long, token long, n long").groupBy("kind", "token").agg(F.sum("n").alias("n"))
    sums = store(sums, "jaccard-counts")
    tables = []
    for kind in (0, 1):
        found = sums.where(F.col("kind") == kind).orderBy(F.desc("n"), "token").limit(HEAVY).toArrow()
        tokens, n = found.column("token").to_numpy().view(np.uint64), found.column("n").to_numpy()
        order = np.argsort(tokens)
        seen = np.zeros(1 << 22, bool)
        seen[tokens >> np.uint64(42)] = True
        tables.append({"token": tokens[order], "n": n[order], "seen": seen})
    return Order(*tables)


SETS = "has_id boolean, id long, text_hash long, n long, class long, point binary, first array<long>"


def _sets(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Each document with the size and class of its set; the first of a class that a task meets also with point and first shingles."""
    shared = rows.sparkSession.sparkContext.broadcast(_most_frequent(rows, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, met = shared.value, set()
        for batch in in_pieces(batches, CHUNK):
            hashes, first = all_words(batch.column(0))
            bounds, hashes, ranks = distinct_shingles(hashes, first, words, order.of_words(hashes))
            ranks = order.of_shingles(hashes, ranks)
            counts, classes = np.diff(bounds), class_of(bounds, hashes)
            lists, points = [], []
            for a, b, name in zip(bounds, bounds[1:], classes.tolist(), strict=False):
                if a == b or name in met:
                    lists.append(None)
                    points.append(None)
                    continue
                met.add(name)
                own = hashes[a:b]
                lists.append(own[np.argsort(ranks[a:b], kind="stable")][: needed(b - a, percent)].view(np.int64))
                point = np.bincount((own >> np.uint64(64 - GROUPS.bit_length() + 1)).astype(np.int64), minlength=GROUPS)
                points.append(point.astype(next(k for k in _KINDS if point.max() < 256 ** np.dtype(k).itemsize)).tobytes())
            made = [pa.array(counts), pa.array(classes), pa.array(points, pa.binary()), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], [c.split()[0] for c in SETS.split(", ")])

    return rows.select("text", "has_id", "id", "text_hash").mapInArrow(run, SETS)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows, sorted by token and class, one for each class whose token another class has."""
    held, held_again = None, False  # the last class of the last token, and whether the token has another
    for batch in batches:
        if not batch.num_rows:
            continue
        token, name = (batch.column(c).to_numpy() for c in ("token", "class"))
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
        if held is not None:
            new[0] = (token[0], name[0]) != (held.column("token")[0].as_py(), held.column("class")[0].as_py())
        if not new.any():
            continue
        batch, token = batch.filter(pa.array(new)), token[new]
        same = np.zeros(len(token) + 1, bool)  # whether row i has the token of the row before it
        same[1:-1] = token[1:] == token[:-1]
        if held is not None:
            same[0] = token[0] == held.column("token")[0].as_py()
            if same[0] or held_again:
                yield held
        again = same[:-1] | same[1:]
        yield batch.slice(0, len(token) - 1).filter(pa.array(again[:-1]))
        held, held_again = batch.slice(len(token) - 1), bool(same[-2])
    if held is not None and held_again:
        yield held


def _cells(sets: DataFrame, percent: int) -> DataFrame:
    """``cell, leaf, class, n``: the classes of all different cells that have one of a near size there, in leaves by size."""
    tokens = sets.select("class", "n", F.explode("first").alias("token"))
    dealt = tokens.repartition(partitions(sets), "token").sortWithinPartitions("token", "class")
    met = store(dealt.mapInArrow(_repeated, "class long, n long, token long"), "jaccard-tokens")
    digests = [F.bit_xor(F.xxhash64("class", F.lit(k))).alias(f"digest{k}") for k in (1, 2)]
    lists = met.groupBy("token").agg(F.count("*").alias("members"), *digests)
    cells = store(lists.groupBy("members", "digest1", "digest2").agg(F.min("token").alias("token")).select("token"), "jaccard-cells")
    rows = met.join(cells, "token").select(F.col("token").alias("cell"), "class", "n")
    by_size = Window.partitionBy("cell").orderBy("n", "class")
    near = (100 * F.lag("n").over(by_size) >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.lead("n").over(by_size))
    rows = rows.withColumns({"leaf": F.floor((F.row_number().over(by_size) - 1) / LEAF).cast("int"), "near": near})
    return store(rows.where("near").drop("near"), "jaccard-places")


def _corners(column: pa.Array) -> np.ndarray:
    """The points of some rows."""
    spelt = column.to_pylist()
    if all(len(p) == GROUPS for p in spelt):
        return np.frombuffer(b"".join(spelt), "u1").reshape(-1, GROUPS)
    return np.array([np.frombuffer(p, _KINDS[(len(p) // GROUPS).bit_length() - 1]) for p in spelt], np.uint32)


def _bounded(left: np.ndarray, right: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether the summed minima of the coordinates allow the overlap that two sets of ``total`` members need."""
    return (100 + percent) * np.minimum(left, right).sum(axis=1, dtype=np.int64) >= percent * total


def _products(a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with i from the run at ``a`` and j from that at ``b``, for every pair of runs."""
    many = a_size * b_size
    pair = np.repeat(np.arange(len(many)), many)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
    return a[pair] + k // b_size[pair], b[pair] + k % b_size[pair]


class Tree:
    """The points of some whole tasks, each of one leaf or of two that meet, packed into nodes."""

    def __init__(self, batch: pa.RecordBatch, percent: int) -> None:
        self.percent = percent
        task = np.stack([batch.column(c).to_numpy() for c in ("cell", "one", "two")], axis=1)
        number = np.concatenate([[0], np.cumsum((task[1:] != task[:-1]).any(axis=1))])
        side, n, classes = (batch.column(c).to_numpy() for c in ("side", "n", "class"))
        points = _corners(batch.column("point"))
        tile = points[:, : GROUPS // 2].sum(axis=1, dtype=np.int64) // 8
        order = np.lexsort((classes, n, tile, side, number))
        self.points, self.n, self.classes = points[order], n[order], classes[order]
        self.label, self.cell = (batch.column(c).to_numpy()[order] for c in ("label", "cell"))
        self.order, self.lists, self.sets = order, batch.column("cells"), {}
        run = 2 * number[order] + side[order]
        begins = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        sizes = np.diff(np.append(begins, len(run)))
        self.place = np.arange(len(run)) - np.repeat(begins, sizes)  # in the run
        first = np.flatnonzero(self.place % NODE == 0)
        self.first, self.size = first, np.diff(np.append(first, len(run)))
        self.run = run[first]

    def pairs_of_nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """Nodes that may hold linked points: of the two leaves of a task, or of its one leaf."""
        corner = np.maximum.reduceat(self.points, self.first, axis=0)
        low, high = np.minimum.reduceat(self.n, self.first), np.maximum.reduceat(self.n, self.first)
        runs, begin, many = np.unique(self.run, return_index=True, return_counts=True)
        other = np.searchsorted(runs, runs + 1)
        has_other = (runs % 2 == 0) & (other < len(runs)) & (runs[np.minimum(other, len(runs) - 1)] == runs + 1)
        alone = (runs % 2 == 0) & ~has_other
        one, two = _products(begin[alone], many[alone], begin[alone], many[alone])
        one, two = one[one <= two], two[one <= two]
        x, y = _products(begin[has_other], many[has_other], begin[other[has_other]], many[other[has_other]])
        one, two = np.concatenate([one, x]), np.concatenate([two, y])
        small, large = np.minimum(high[one], high[two]), np.maximum(low[one], low[two])
        near = (one == two) | (100 * small >= self.percent * large)
        one, two = one[near], two[near]
        kept = [np.zeros(0, bool)]
        for a in range(0, len(one), PAIRS):
            i, j = one[a : a + PAIRS], two[a : a + PAIRS]
            kept.append((i == j) | _bounded(corner[i], corner[j], low[i] + low[j], self.percent))
        return one[np.concatenate(kept)], two[np.concatenate(kept)]

    def _cells_of(self, i: int) -> frozenset:
        if i not in self.sets:
            self.sets[i] = frozenset(self.lists[self.order[i]].as_py())
        return self.sets[i]

    def _first_met(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether no earlier cell holds both points."""
        pairs = zip(i.tolist(), j.tolist(), self.cell[i].tolist(), strict=True)
        return np.array([min(self._cells_of(a) & self._cells_of(b)) == cell for a, b, cell in pairs], bool)

    def survivors(self, i: np.ndarray, j: np.ndarray, once: bool) -> pa.RecordBatch:
        """Those of the pairs of points that have different labels and may be linked; ``once`` over all cells."""
        small, large = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        ok = (self.label[i] != self.label[j]) & (100 * small >= self.percent * large)
        i, j = i[ok], j[ok]
        kept = [np.zeros(0, bool)]
        for a in range(0, len(i), PAIRS):
            p, q = i[a : a + PAIRS], j[a : a + PAIRS]
            kept.append(_bounded(self.points[p], self.points[q], self.n[p] + self.n[q], self.percent))
        i, j = i[np.concatenate(kept)], j[np.concatenate(kept)]
        if once:
            first = self._first_met(i, j)
            i, j = i[first], j[first]
        a, b = np.minimum(self.classes[i], self.classes[j]), np.maximum(self.classes[i], self.classes[j])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])

    def next_ones(self) -> Iterator[pa.RecordBatch]:
        """Survivors of each point and the next ones of its run."""
        for k in range(1, AHEAD + 1):
            j = np.flatnonzero(self.place >= k)
            yield self.survivors(j - k, j, once=False)

    def all_pairs(self) -> Iterator[pa.RecordBatch]:
        """Survivors of all points of all nodes that may hold some."""
        one, two = self.pairs_of_nodes()
        step = max(1, 8 * PAIRS // NODE**2)
        for a in range(0, len(one), step):
            x, y = one[a : a + step], two[a : a + step]
            i, j = _products(self.first[x], self.size[x], self.first[y], self.size[y])
            once = (np.repeat(x, self.size[x] * self.size[y]) != np.repeat(y, self.size[x] * self.size[y])) | (i < j)
            yield self.survivors(i[once], j[once], once=True)


def _whole_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by task, in batches that hold whole tasks."""

    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < POINTS:
            continue
        every = joined(held)
        keys = [every.column(c).to_numpy() for c in ("cell", "one", "two")]
        other = np.any([k != k[-1] for k in keys], axis=0)
        done = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if done:
            yield every.slice(0, done)
        held, rows = [every.slice(done)], every.num_rows - done
    if rows:
        yield joined(held)


def _candidates(places: DataFrame, points: DataFrame, percent: int, next_only: bool) -> DataFrame:
    """``u, v``: different pairs of classes with different labels that may be linked; ``u`` is the smaller."""
    leaves = places.groupBy("cell", "leaf").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    if next_only:
        tasks = leaves.select("cell", "leaf", F.col("leaf").alias("one"), F.col("leaf").alias("two"), F.lit(0).alias("side"))
    else:
        leaves = store(leaves, "jaccard-leaves")
        one, two = leaves.alias("one"), leaves.alias("two")
        near = (F.col("one.leaf") <= F.col("two.leaf")) & (100 * F.col("one.high") >= percent * F.col("two.low"))
        tasks = one.join(two, (F.col("one.cell") == F.col("two.cell")) & near)
        sides = [F.struct(F.col(f"{s}.leaf").alias("leaf"), F.lit(k).alias("side")) for k, s in enumerate(("one", "two"))]
        both = F.when(F.col("one.leaf") == F.col("two.leaf"), F.array(sides[0])).otherwise(F.array(*sides))
        tasks = tasks.select(F.col("one.cell").alias("cell"), F.col("one.leaf").alias("one"), F.col("two.leaf").alias("two"), F.explode(both).alias("s"))
        tasks = tasks.select("cell", "one", "two", "s.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_tasks(batches):
            tree = Tree(batch, percent)
            yield from tree.next_ones() if next_only else tree.all_pairs()

    task = ["cell", "one", "two"]
    dealt = places.join(tasks, ["cell", "leaf"]).select(*task, "side", "class", "n", "label")
    dealt = dealt.join(points, "class").select(*task, "side", "class", "n", "point", "label", "cells")
    dealt = dealt.repartition(partitions(places), *task).sortWithinPartitions(*task)
    found = dealt.mapInArrow(run, "u long, v long")
    return found.distinct() if next_only else found


def _tokens_of(rows: DataFrame, sets: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """``class, tokens`` of the given classes, and of some others, from one text of each."""
    row = F.xxhash64("has_id", "id", "text_hash")
    some = sets.join(classes, "class", "left_semi").groupBy("class").agg(F.min(row).alias("row"))
    bits = F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(row, {BITS}) & 63 AS int))")).alias("bits")
    field = some.groupBy(F.expr(f"pmod(row, {BITS}) div 64").alias("at")).agg(bits)
    field = store(field, "jaccard-field")  # at most BITS / 64 rows of 16 bytes
    marked = rows.withColumn("row", row).join(F.broadcast(field), F.expr(f"pmod(row, {BITS}) div 64 = at"))
    marked = marked.where(F.expr(f"shiftrightunsigned(bits, cast(pmod(row, {BITS}) & 63 AS int)) & 1L = 1L"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in in_pieces(batches, CHUNK):
            bounds, hashes = sets_of(batch.column(0), words)
            names = class_of(bounds, hashes)
            new = np.array([n not in met and not met.add(n) for n in names.tolist()], bool)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), _longs(hashes))
            yield pa.RecordBatch.from_arrays([pa.array(names), lists], ["class", "tokens"]).filter(pa.array(new))

    found = store(marked.select("text").mapInArrow(run, "class long, tokens array<long>"), "jaccard-sets")
    # Rows that repeat id and text come once from each task; only then are sets shuffled to drop the others.
    again = found.groupBy("class").count().where("count > 1")
    return found.dropDuplicates(["class"]) if again.limit(1).count() else found


def _verified(rows: DataFrame, sets: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs whose whole sets are similar enough."""
    classes = pairs.select(F.explode(F.array("u", "v")).alias("class")).distinct()
    tokens = _tokens_of(rows, sets, classes, words)
    left, right = (tokens.select(F.col("class").alias(c), F.col("tokens").alias(f"{c}_tokens")) for c in ("u", "v"))
    both = pairs.join(left, "u").join(right, "v")
    shared = F.size(F.array_intersect("u_tokens", "v_tokens")).cast("long")
    enough = (100 + percent) * shared >= percent * (F.size("u_tokens") + F.size("v_tokens")).cast("long")
    return both.where(enough).select("u", "v")


def linked_classes(rows: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, root``: every class that is linked, and the smallest class that can be reached from it."""
    places = _cells(sets, percent)
    # A class is in one cell for each of its first shingles at most.
    lists = places.groupBy("class").agg(F.collect_list("cell").alias("cells"))
    points = sets.where("point IS NOT NULL").select("class", "point").join(lists.select("class"), "class", "left_semi").dropDuplicates(["class"])
    points = store(points.join(lists, "class"), "jaccard-points")
    tried = store(_candidates(places.withColumn("label", F.col("class")), points, percent, next_only=True), "jaccard-next")
    joined = united(_verified(rows, sets, tried, words, percent), "jaccard-joined")
    labelled = places.join(joined.withColumnsRenamed({"node": "class", "root": "label"}), "class", "left")
    labelled = store(labelled.withColumn("label", F.coalesce("label", "class")), "jaccard-labelled")
    several = labelled.groupBy("cell").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").select("cell")
    labelled = store(labelled.join(store(several, "jaccard-several"), "cell", "left_semi"), "jaccard-left")
    rest = store(_candidates(labelled, points, percent, next_only=False).join(tried, ["u", "v"], "left_anti"), "jaccard-rest")
    links = _verified(rows, sets, rest, words, percent)
    return united(links.union(joined.select("node", "root")), "jaccard-linked")


def similar_documents(docs: DataFrame, words: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: ``doc_id, n_shingles, component_id``."""
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    rows = docs.select(
        F.col(key).isNotNull().alias("has_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    sets = store(_sets(rows, words, percent), "jaccard-sets-of-documents")
    linked = linked_classes(rows, sets, words, percent)
    own = F.when(F.col("has_id"), F.col("id"))
    names = sets.where("n > 0").groupBy("class").agg(F.min(own).alias("id"))
    roots = names.join(linked.withColumnRenamed("node", "class"), "class", "left").select("class", "id", F.coalesce("root", "class").alias("root"))
    roots = store(roots, "jaccard-roots")
    named = store(roots.groupBy("root").agg(F.min("id").alias("component_id")), "jaccard-names")
    # Stored, so that the joins are of plain tables and a class of very many copies can be split.
    found = store(roots.join(named, "root").select("class", "component_id"), "jaccard-found")
    full = sets.where("n > 0").select("class", own.alias("doc_id"), F.col("n").alias("n_shingles")).join(found, "class")
    empty = sets.where("n = 0").select(own.alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id"))
    return full.select("doc_id", "n_shingles", "component_id").union(empty)
