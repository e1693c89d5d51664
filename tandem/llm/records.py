"""Token ids as length-delimited binary records, with an offset index beside each file.

A file is a row of frames, as in the public TFRecord format but with the CRC-32 of zlib:

    length   8 bytes, little-endian      bytes of the payload
    check    4 bytes                     masked CRC-32 of the length bytes
    payload  1 byte: 1 if there is an id, 1 byte: bytes a token (2 or 4), 8 bytes: id, signed, then the tokens
    check    4 bytes                     masked CRC-32 of the payload

A checksum of data that itself holds checksums is weak, so it is rotated by 15 bits and a constant is added.
Beside ``part-00007.rec`` lies ``part-00007.idx``: for each record its offset and its first token's number in the
file, 8 bytes each, so a record is reached without reading those before it. Files are written under a name of the
attempt and then renamed, so a task that is run again leaves the same file.

Texts are encoded with the given tokenizer file. The pre-tokenizer never joins the characters on both sides of a space or
line break after a non-space, and a byte-level one never those of a letter or digit and a mark after it, so texts are cut there,
all texts of some megabytes at once; each different piece is encoded once and remembered. A text that holds a special token of the
tokenizer stays whole.

Defined results: a null or empty text has the end id alone; rows with the same id are ordered by their ids, null
document ids come first; an empty table writes no file and gives no row.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm import ordered
from tandem.llm.words import cut_at, gathered, in_pieces, own_bytes_of, table_of
from tandem.session import work_folder

_MASK = 0xA282EAD8
_HEAD = struct.Struct("<BBq")
#: Pieces remembered by a worker process, some 110 MB. When they are full, those that came only once are forgotten.
REMEMBERED = 500_000
#: Bytes of text that are cut at a time.
CHUNK = 1 << 22


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked_crc(size)), payload, struct.pack("<I", masked_crc(payload))))


def payload_of(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _HEAD.pack(doc_id is not None, width, doc_id or 0) + ids


def ids_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    has_id, width, doc_id = _HEAD.unpack_from(payload)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", offset=_HEAD.size)


class Damaged(ValueError):
    """A frame whose length or checksum is wrong."""


def read_frame(file, offset: int | None = None) -> bytes | None:
    """The payload of the frame at ``offset`` or where the file stands; None at the end of the file."""
    if offset is not None:
        file.seek(offset)
    head = file.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked_crc(head[:8]):
        raise Damaged(f"length at {offset}")
    (size,) = struct.unpack("<Q", head[:8])
    payload, check = file.read(size), file.read(4)
    if len(payload) < size or len(check) < 4 or struct.unpack("<I", check)[0] != masked_crc(payload):
        raise Damaged(f"payload at {offset}")
    return payload


def file_system(folder: str):
    """The file system of a folder named by path or address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _byte_letters(spec: dict) -> dict[int, int] | None:
    """How a byte-level vocabulary spells bytes, if the tokenizer does nothing else to a word of letters.

    Printable bytes of Latin-1 stand for themselves, the others follow from U+0100 on.
    """
    step, model = spec.get("pre_tokenizer") or {}, spec["model"]
    byte_level = step.get("type") == "ByteLevel" and not step.get("add_prefix_space") and step.get("use_regex", True)
    if not byte_level or spec.get("normalizer") or model.get("type") != "BPE" or model.get("dropout"):
        return None
    itself = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in itself]
    return {**{b: b for b in itself}, **{b: 256 + i for i, b in enumerate(others)}}


_WHITE = table_of((*range(0x09, 0x0E), *range(0x1C, 0x21)))
_MARKS = table_of(tuple(b for b in range(0x21, 0x7F) if not chr(b).isalnum()))
_ALNUM = table_of(tuple(b for b in range(0x21, 0x7F) if chr(b).isalnum()))


def _white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space of any alphabet."""
    white = _WHITE[data]
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(lead):
        a, b, c = data[lead], data[np.minimum(lead + 1, len(data) - 1)], data[np.minimum(lead + 2, len(data) - 1)]
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        general = (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)
        three = (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & general | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        for k, found in ((0, two | three), (1, two | three), (2, three)):
            white[lead[found] + k] = True
    return white


def piece_starts(data: np.ndarray, at: np.ndarray, marks: bool, whole: np.ndarray) -> np.ndarray:
    """Where pieces begin whose ids, one after the other, are those of the texts: at each text; before a space or line break after
    a non-space; after a line break between non-spaces; with ``marks`` before an ASCII mark after a Latin letter or a digit.
    Texts numbered in ``whole`` are not cut."""
    if not len(data):
        return np.zeros(0, np.int64)
    white, begins = _white_space(data), np.zeros(len(data), bool)
    before = np.concatenate([[True], ~white[:-1]])
    begins |= before & ((data == 0x20) | (data == 0x0A))
    begins[2:] |= ~white[2:] & (data[1:-1] == 0x0A) & before[1:-1]
    if marks:
        letter = _ALNUM[data]
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begins[1:] |= _MARKS[data[1:]] & letter[:-1]
    for i in whole:
        begins[at[i] : at[i + 1]] = False
    begins[at[:-1][at[1:] > at[:-1]]] = True
    return np.flatnonzero(begins)


class Pieces:
    """Encodes texts piece by piece; ``width`` bytes a token."""

    #: Letters of Latin alphabets with or without a space in front, then ASCII marks without the apostrophe.
    _word_and_marks = re.compile(r"( ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, tokenizer_file: str, width: int, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.dtype, self.known, self.again, self.most = f"<u{width}", {}, set(), remembered
        spec = json.loads(self.tokenizer.to_str())
        self.letters = _byte_letters(spec)
        self.special = [t["content"].encode() for t in spec.get("added_tokens") or []]

    def encode(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids by piece. A word, and marks after it, are a step each of a byte-level pre-tokenizer, so they go straight to
        the library's model; all other pieces go the whole way."""
        ids = {}
        for piece in pieces if self.letters else ():
            if (m := self._word_and_marks.fullmatch(piece)) is not None:
                ids[piece] = self._spelt(m[1]) + (self._spelt(m[2]) if m[2] else b"")
        rest = [p for p in pieces if p not in ids]
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        ids.update(zip(rest, (self._bytes(e.ids) for e in found), strict=True))
        return ids

    def _spelt(self, step: str) -> bytes:
        spelt = step.encode().decode("latin-1").translate(self.letters)
        return self._bytes([t.id for t in self.tokenizer.model.tokenize(spelt)])

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _whole(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The numbers of the texts that hold a special token."""
        raw, found = data.tobytes() if self.special else b"", []
        for token in self.special:
            place = raw.find(token)
            while place >= 0:
                found.append(place)
                place = raw.find(token, place + 1)
        return np.unique(np.searchsorted(at, np.array(found, np.int64), side="right") - 1)

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where those of each text begin (and the last end)."""
        data, at = own_bytes_of(texts)
        starts = piece_starts(data, at, self.letters is not None, self._whole(data, at))
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        coded = cut_at(data, starts).dictionary_encode()
        ids = self._ids_of(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(self.dtype).itemsize
        found, begins = gathered(np.frombuffer(b"".join(ids), self.dtype), sizes, coded.indices.to_numpy())
        return found, begins[np.searchsorted(starts, at)]

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        new = [p for p in pieces if p not in self.known]
        used = set(pieces).difference(new)
        self.again |= used
        if len(self.known) + len(new) > self.most:
            kept = self.again if len(self.again) < self.most // 2 else used
            self.known, self.again = {p: self.known[p] for p in kept}, set()
        self.known.update(self.encode(new))
        return [self.known[p] for p in pieces]

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        found, begins = self.tokens(pa.array(texts, pa.large_string()))
        for a, b in zip(begins, begins[1:], strict=False):
            yield found[a:b].tobytes()


@lru_cache(maxsize=1)
def pieces_of(tokenizer_file: str, width: int) -> Pieces:
    """One for all tasks that a worker process runs, so that later tasks know the pieces of earlier ones."""
    return Pieces(tokenizer_file, width)


ENCODED = "has_id boolean, id long, ids binary"


def encoded(docs: DataFrame, tokenizer_file: str, end_id: int | None, width: int, key: str, text: str) -> DataFrame:
    """``has_id, id, ids``: the tokens of each text in ``width`` bytes each, with the end id."""
    end = b"" if end_id is None else int(end_id).to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pieces = pieces_of(tokenizer_file, width)
        for batch in in_pieces(batches, CHUNK):
            found, begins = pieces.tokens(batch.column(0))
            ids = [found[a:b].tobytes() + end for a, b in zip(begins, begins[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(ids, pa.binary())], ["has_id", "id", "ids"])

    rows = docs.select(
        F.col(key).isNotNull().alias("has_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return rows.select("text", "has_id", "id").mapInArrow(run, ENCODED)


WRITTEN = "part int, path string, n_records long, n_tokens long, n_bytes long"


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    end_id: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> list[tuple[int, str, int, int, int]]:
    """Encode all texts and write them in ascending order of the key, a file and its index for each key range.

    Returns what was written, by file: one entry a file, as many as the session has shuffle partitions at most.
    """
    width = _width_for(tokenizer_file, end_id)
    keys = docs.select(F.col(key).cast("long").alias("id"))
    bounds = ordered.key_bounds(keys, "id", ordered.bucket_count(docs))
    rows = encoded(docs, tokenizer_file, end_id, width, key, text)
    order = rows.withColumn("id", F.when(F.col("has_id"), F.col("id")))
    dealt = ordered.deal(order, "id", bounds, "ids").select(
        F.col(ordered.BUCKET).alias("part"), "has_id", F.coalesce("id", F.lit(0)).alias("id"), "ids"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        for batch in batches:
            if len(batch) and out is None:
                part = int(batch["part"].iloc[0])
                out = _Writer(folder, part, width)
            for has_id, doc_id, ids in zip(batch["has_id"], batch["id"], batch["ids"], strict=True):
                out.add(int(doc_id) if has_id else None, ids)
        if out is not None:
            yield pd.DataFrame([(part, out.path, *out.close())], columns=[c.split()[0] for c in WRITTEN.split(", ")])

    return sorted(tuple(r) for r in dealt.mapInPandas(run, WRITTEN).collect())


def _width_for(tokenizer_file: str, end_id: int | None) -> int:
    from tokenizers import Tokenizer

    most = max(Tokenizer.from_file(tokenizer_file).get_vocab_size(with_added_tokens=True) - 1, end_id or 0)
    return 2 if most < 1 << 16 else 4


class _Writer:
    """Frames and offsets of one file, under a name of this attempt until it is whole."""

    def __init__(self, folder: str, part: int, width: int) -> None:
        self.fs, root = file_system(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.width = f"part-{part:05d}.rec", width
        self.final = f"{root}/part-{part:05d}"
        self.attempt = f"{root}/.{uuid.uuid4().hex}"
        self.records, self.index = self.fs.open_output_stream(f"{self.attempt}.rec"), self.fs.open_output_stream(f"{self.attempt}.idx")
        self.n_records = self.n_tokens = self.n_bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.write(struct.pack("<QQ", self.n_bytes, self.n_tokens))
        data = frame(payload_of(doc_id, ids, self.width))
        self.records.write(data)
        self.n_records += 1
        self.n_tokens += len(ids) // self.width
        self.n_bytes += len(data)

    def close(self) -> tuple[int, int, int]:
        self.records.close()
        self.index.close()
        for ending in ("rec", "idx"):
            self.fs.move(f"{self.attempt}.{ending}", f"{self.final}.{ending}")
        return self.n_records, self.n_tokens, self.n_bytes


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_back(spark: SparkSession, folder: str, written: list[tuple[int, str, int, int, int]]) -> DataFrame:
    """Per record of the files: its id, the tokens before it over all files, its tokens and the CRC-32 of its ids.

    Each file is read by one task, every frame's checksums are compared, and a damaged file or one with another
    number of records fails the job. The CRC-32 is over the ids as little-endian 32-bit integers.
    """
    starts, before = [], 0
    for part, path, n_records, n_tokens, _ in written:
        starts.append((part, path, n_records, before))
        before += n_tokens
    files = spark.createDataFrame(starts, "part int, path string, n_records long, start long")
    if starts:
        files = files.repartitionById(max(s[0] for s in starts) + 1, F.col("part"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in READ.split(", ")]
        for batch in batches:
            for path, n_records, start in zip(batch["path"], batch["n_records"], batch["start"], strict=True):
                seen = 0
                for part in _chunks(records_of(folder, path), 4096):
                    out = []
                    for doc_id, ids in part:
                        out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                    seen += len(out)
                    yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
                if seen != n_records:
                    raise Damaged(f"{path}: {seen} records of {n_records}")

    return files.mapInPandas(run, READ)


def _chunks(items: Iterator, n: int) -> Iterator[list]:
    part = []
    for item in items:
        part.append(item)
        if len(part) == n:
            yield part
            part = []
    if part:
        yield part


def records_of(folder: str, path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, tokens) of every record of a file, in order; raises ``Damaged``."""
    fs, root = file_system(folder)
    with fs.open_input_stream(f"{root}/{path}", buffer_size=1 << 20) as file:
        while (payload := read_frame(file)) is not None:
            yield ids_of(payload)


def offsets_of(folder: str, path: str) -> np.ndarray:
    """The index of a file: a row (offset, first token) for each record, for reads in any order."""
    fs, root = file_system(folder)
    with fs.open_input_stream(f"{root}/{path[:-4]}.idx") as file:
        return np.frombuffer(file.read(), "<u8").reshape(-1, 2)


def record_at(folder: str, path: str, offset: int) -> tuple[int | None, np.ndarray]:
    """The record at an offset of the index."""
    fs, root = file_system(folder)
    with fs.open_input_file(f"{root}/{path}") as file:
        return ids_of(read_frame(file, int(offset)))


def write_and_read(docs: DataFrame, tokenizer_file: str, end_id: int | None = None) -> DataFrame:
    """Write the documents as records into the shared folder and read the files again."""
    spark = docs.sparkSession
    folder = work_folder(spark, "records")
    return read_back(spark, folder, write_records(docs, folder, tokenizer_file, end_id))
