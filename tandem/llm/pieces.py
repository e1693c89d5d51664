"""SentencePiece encoding and decoding by a streaming Viterbi search.

The best segmentation of a text is the path of pieces with the highest sum of scores. It is found letter by
letter: only positions a longest piece back can still be left by a new piece, so these positions are the front. From time to time the
back-pointers of the whole front are followed; where they all meet, everything before is settled whatever
follows, so its ids are given out and its positions forgotten. A text of any length needs a window of a few pieces.

Where no piece of the vocabulary reaches across a boundary (before a space, around a line break, between a letter or digit and a
mark after it, if the vocabulary is so made), every path meets there. Such units are settled on their own. All texts of some megabytes
are cut into units at once, each different unit is searched once, and those that were met before are remembered.

Scores are read as log-probabilities of single pieces, as in a unigram model; a vocabulary that was made by
merging has scores of rank, which are used the same way, so its ids are those of this search and not of the merges. A
character without a piece costs the lowest score less 10 and is written as its bytes if the vocabulary has them.
Ties go to the path whose last piece is longer.

Defined results: a null or empty text has no ids; decoding gives back the text, but for a text that holds the mark of
a space itself (U+2581), which comes back as a space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.words import cut_at, gathered, in_pieces, mixed, own_bytes_of, table_of

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Bytes of text that are cut into units at a time.
CHUNK = 1 << 22

_ALNUM = table_of(tuple(b for b in range(128) if chr(b).isalnum()))
_LATIN = frozenset(map(chr, range(0xC0, 0x100))) - {"×", "÷"}
_MARKS = [chr(b) for b in range(0x21, 0x7F) if not chr(b).isalnum()]


class Vocabulary:
    """The pieces of a SentencePiece model file, with scores, and what follows from them."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int] | None, unknown: int, spellings: list[bytes]) -> None:
        self.pieces, self.byte_ids, self.unknown, self.spellings = pieces, byte_ids, unknown, spellings
        self.longest = max(map(len, pieces), default=1)
        #: All ends of pieces: where a text's end is none of them, no longer piece ends there either.
        self.ends = {p[k:] for p in pieces for k in range(len(p))}
        self.no_piece = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        longer = [p for p in pieces if len(p) > 1]
        #: Whether every path has a boundary before a space that follows another character, and around a line break.
        self.space_parts = not any(a != SPACE and b == SPACE for p in longer for a, b in zip(p, p[1:], strict=False))
        self.line_parts = not any("\n" in p for p in longer)
        #: Marks before which every path has a boundary if a letter of a Latin alphabet or a digit stands there.
        joined = {b for p in longer for a, b in zip(p, p[1:], strict=False) if a in _LATIN or a.isascii() and a.isalnum()}
        self.mark_parts = table_of(tuple(ord(m) for m in _MARKS if m not in joined))
        self.spelt = pa.array(spellings, pa.large_binary())

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if model.normalize("A  é́ Ａ") != f"{SPACE}A{SPACE}{SPACE}é́{SPACE}Ａ":
            raise ValueError("the model changes texts before it cuts them; only a space in front is supported")
        pieces, byte_ids, spellings = {}, {}, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                spellings.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spellings.append(b"")
            else:
                pieces[piece] = (i, model.get_score(i))
                spellings.append(piece.replace(SPACE, " ").encode())
        return cls(pieces, [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None, model.unk_id(), spellings)

    def ids_of_unknown(self, ch: str) -> list[int]:
        return [self.unknown] if self.byte_ids is None else [self.byte_ids[b] for b in ch.encode("utf-8", "surrogatepass")]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.spellings.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Search:
    """A Viterbi search over a stream of characters; ``feed`` gives out ids as soon as they are settled."""

    #: Positions after which the front is asked whether its paths meet.
    ASK = 64

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.text = ""  # from the last settled boundary on
        self.best: list[float] = [0.0]  # by position, best sum that ends here
        self.back: list[int] = [0]  # and where its last piece begins
        self.asked = 0

    def _extend(self) -> None:
        """Bring every position of the text up to date; positions are final once all starts before them are tried."""
        text, best, pieces, ends = self.text, self.best, self.v.pieces, self.v.ends
        for end in range(len(best), len(text) + 1):
            start_of_top = end - 1
            found = pieces.get(text[start_of_top])
            top = best[start_of_top] + (self.v.no_piece if found is None else found[1])
            for start in range(end - 2, max(-1, end - self.v.longest - 1), -1):
                part = text[start:end]
                if part not in ends:
                    break
                found = pieces.get(part)
                if found is not None and best[start] + found[1] >= top:
                    top, start_of_top = best[start] + found[1], start
            best.append(top)
            self.back.append(start_of_top)

    def _ids(self, end: int) -> list[int]:
        parts = []
        while end:
            start = self.back[end]
            found = self.v.pieces.get(self.text[start:end])
            parts.append([found[0]] if found is not None else self.v.ids_of_unknown(self.text[start:end]))
            end = start
        return [i for part in reversed(parts) for i in part]

    def _meeting(self) -> int:
        """The last boundary that all paths into the front share."""
        n = len(self.text)
        front = set(range(max(0, n - self.v.longest + 1), n + 1))
        while len(front) > 1:
            last = max(front)
            front.remove(last)
            front.add(self.back[last])
        return front.pop()

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        for at in range(0, len(text), self.ASK):
            self.text += text[at : at + self.ASK]
            self._extend()
            if len(self.text) - self.asked < self.ASK:
                continue
            if meeting := self._meeting():
                out += self._ids(meeting)
                self.text = self.text[meeting:]
                base = self.best[meeting]
                self.best = [b - base for b in self.best[meeting:]]
                self.back = [max(0, b - meeting) for b in self.back[meeting:]]
            self.asked = len(self.text)
        return out

    def finish(self) -> list[int]:
        out = self._ids(len(self.text))
        self.text, self.best, self.back, self.asked = "", [0.0], [0], 0
        return out


class Encoder:
    """Encodes whole texts unit by unit; ids of units are remembered up to a bound, those used last.

    Units hold plain spaces, so that most are ASCII and small. They live in two tables of half the bound each: when the
    young one is full it becomes the old one, and what is met again moves from there to the new young one.
    """

    REMEMBERED = 250_000
    #: Letters of the longest units that are searched many at a time, and how many at least.
    SHORT, MANY = 24, 16
    _BASE = 0x9E3779B97F4A7C15

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        short = [p for p in vocabulary.pieces if len(p) <= self.SHORT]
        hashes = np.array([self._hash_of(p) for p in short], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.strings = hashes[order], [short[i] for i in order]
        self.scores = np.array([vocabulary.pieces[p][1] for p in self.strings], float)
        self.up, self.down = (
            np.array([pow(b, k, 1 << 64) for k in range(self.SHORT + 1)], np.uint64) for b in (self._BASE, pow(self._BASE, -1, 1 << 64))
        )
        self.kind = "<u2" if len(vocabulary.spellings) <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def search(self, unit: str) -> bytes:
        search = Search(self.v)
        return np.array(search.feed(unit.replace(" ", SPACE)) + search.finish(), self.kind).tobytes()

    def _hash_of(self, piece: str) -> int:
        total = sum(ord(ch) * pow(self._BASE, k, 1 << 64) for k, ch in enumerate(piece)) + (len(piece) << 56)
        return int(mixed(np.array([total % (1 << 64)], np.uint64))[0])

    def _of_one_length(self, units: list[str], n: int) -> list[bytes]:
        """The same search for many units of ``n`` letters at once: one step settles a position of all of them."""
        marked = [u.replace(" ", SPACE) for u in units]
        letters = np.array(marked, f"<U{n}").view("<u4").reshape(len(units), n).astype(np.uint64)
        sums = np.zeros((n + 1, len(units)), np.uint64)
        np.cumsum(letters.T * self.up[:n, None], axis=0, out=sums[1:])
        best, back = np.zeros((n + 1, len(units))), np.zeros((n + 1, len(units)), np.int64)
        found = np.full((n + 1, len(units)), -1)
        for end in range(1, n + 1):
            for start in range(end - 1, max(-1, end - self.v.longest - 1), -1):
                hashes = mixed((sums[end] - sums[start]) * self.down[start] + np.uint64((end - start) << 56))
                at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
                hit = self.hashes[at] == hashes
                if start == end - 1:
                    best[end], back[end] = best[start] + np.where(hit, self.scores[at], self.v.no_piece), start
                    found[end] = np.where(hit, at, -1)
                else:
                    hit &= best[start] + self.scores[at] >= best[end]
                    best[end, hit], back[end, hit], found[end, hit] = (best[start] + self.scores[at])[hit], start, at[hit]
        out = []
        for unit, text, starts, pieces in zip(units, marked, back.T.tolist(), found.T.tolist(), strict=True):
            ids, end = [], n
            while end:
                start, piece = starts[end], pieces[end]
                if piece < 0:
                    ids.append(self.v.ids_of_unknown(text[start]))
                elif self.strings[piece] != text[start:end]:  # two hashes are the same
                    break
                else:
                    ids.append([self.v.pieces[text[start:end]][0]])
                end = start
            out.append(self.search(unit) if end else np.array([i for part in reversed(ids) for i in part], self.kind).tobytes())
        return out

    def search_all(self, units: list[str]) -> list[bytes]:
        by_length: dict[int, list[int]] = {}
        for i, unit in enumerate(units):
            by_length.setdefault(len(unit), []).append(i)
        out = [b""] * len(units)
        for n, places in by_length.items():
            some = [units[i] for i in places]
            alone = n > self.SHORT or len(some) < self.MANY or not self.strings
            for i, ids in zip(places, map(self.search, some) if alone else self._of_one_length(some, n), strict=True):
                out[i] = ids
        return out

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts with a space in front, where each text begins (and the last ends), and the places at which units
        begin: at their ends all paths meet. A text with a space's own mark is one unit; an empty text has none."""
        data, at = own_bytes_of(texts)
        full = at[1:] > at[:-1]
        data = np.insert(data, at[:-1][full], 0x20)
        at = at + np.concatenate([[0], np.cumsum(full)])
        begins = np.zeros(len(data), bool)
        if self.v.space_parts:
            begins[1:] |= (data[1:] == 0x20) & (data[:-1] != 0x20)  # a run of spaces may be one piece
        if self.v.line_parts:
            begins |= data == 0x0A
            begins[1:] |= data[:-1] == 0x0A
        letter = _ALNUM[data]
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begins[1:] |= self.v.mark_parts[data[1:]] & letter[:-1]
        marked = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
        for i in np.unique(np.searchsorted(at, marked, side="right") - 1):
            begins[at[i] : at[i + 1]] = False
        begins[at[:-1][full]] = True
        return data, at, np.flatnonzero(begins)

    def ids_of(self, units: list[str]) -> list[bytes]:
        """The ids of different units."""
        known = {}
        for unit in units:
            ids = self.known.get(unit)
            if ids is None and (ids := self.old.pop(unit, None)) is not None:
                self.known[unit] = ids
            if ids is not None:
                known[unit] = ids
        new = [u for u in units if u not in known]
        known.update(zip(new, self.search_all(new), strict=True))
        if len(self.known) + len(new) > self.REMEMBERED // 2:
            self.old, self.known = self.known, {}
        self.known.update((u, known[u]) for u in new if len(u) <= 64)
        return [known[u] for u in units]

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where those of each text begin (and the last end)."""
        data, at, starts = self.units(texts)
        if not len(starts):
            return np.zeros(0, self.kind), np.zeros(len(texts) + 1, np.int64)
        coded = cut_at(data, starts).dictionary_encode()
        ids = self.ids_of(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(self.kind).itemsize
        found, begins = gathered(np.frombuffer(b"".join(ids), self.kind), sizes, coded.indices.to_numpy())
        return found, begins[np.searchsorted(starts, at)]

    def encode(self, text: str | None) -> np.ndarray:
        return self.tokens(pa.array([text], pa.large_string()))[0]


@lru_cache(maxsize=1)
def encoder_of(model_file: str) -> Encoder:
    """One for all tasks that a worker process runs, so that later tasks know the units of earlier ones."""
    return Encoder(Vocabulary.load(model_file))


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns and the ids of each text; an ``ids`` column that exists is replaced."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_of(model_file)
        for texts in batches:
            parts = []
            for part in in_pieces([pa.RecordBatch.from_arrays([texts], ["text"])], CHUNK):
                found, begins = encoder.tokens(part.column(0))
                parts.append(pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(found.astype(np.int32))))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return docs.withColumn(ids, F.arrow_udf(run, "array<int>")(text))


def decode_documents(docs: DataFrame, model_file: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """All columns and the text of each row's ids; no ids give an empty text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = encoder_of(model_file).v
        for rows in batches:
            yield pd.Series([vocabulary.decode([] if r is None else list(r)) for r in rows], dtype=object)

    return docs.withColumn(text, F.pandas_udf(run, "string")(ids))


ROUND_TRIP = "n_chars long, n_ids long, ids_sha256 string, decoded_sha256 string, round_trip boolean"


def round_trips(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the text's length and number of ids, digests of the ids (little-endian, 32 bits) and of the text that
    they decode to, and whether that is the text. Ids stay in the task that made them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model_file)
        for batch in in_pieces(batches, CHUNK):
            data, at = own_bytes_of(batch.column(0))
            found, begins = encoder.tokens(batch.column(0))
            spelt = encoder.v.spelt.take(pa.array(found))
            places = np.frombuffer(spelt.buffers()[1], np.int64)[spelt.offset :][: len(found) + 1] if len(found) else np.zeros(1, np.int64)
            raw, texts, wide = spelt.buffers()[2], data.tobytes(), found.astype("<u4")
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            out = []
            for i in range(batch.num_rows):
                a, b = begins[i], begins[i + 1]
                text, back = texts[at[i] : at[i + 1]], raw[places[a] : places[b]].to_pybytes() if b > a else b""
                if back != b" " + text and (back or text):  # the text itself holds a mark or is no UTF-8
                    back = b" " + encoder.v.decode(found[a:b].tolist()).encode()
                digests = hashlib.sha256(wide[a:b].tobytes()).hexdigest(), hashlib.sha256(back[1:]).hexdigest()
                out.append((int(chars[at[i + 1]] - chars[at[i]]), int(b - a), *digests, back[1:] == text))
            names = [c.split()[0] for c in ROUND_TRIP.split(", ")]
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *map(pa.array, columns)], ["has_id", "id", *names])

    rows = docs.select(F.col(text).alias("text"), F.col(key).isNotNull().alias("has_id"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"))
    found = rows.mapInArrow(run, f"has_id boolean, id long, {ROUND_TRIP}")
    return found.withColumn("doc_id", F.when(F.col("has_id"), F.col("id"))).select("doc_id", *[c.split()[0] for c in ROUND_TRIP.split(", ")])
