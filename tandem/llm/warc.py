"""WARC archives: one writer, and a reader that salvages what a damaged archive still holds.

Writing: each page becomes a record in a gzip member of its own. Of pages with equal payloads of at least ``revisit_from``
bytes the one with the largest id is a ``response``, the others are ``revisit`` records that name it. Files have
names of their own attempt, and the manifest, a table in the shared folder, lists those of attempts that
ended; what a lost executor left behind is in no manifest and is never read.

Reading: a member is unpacked in pieces and its records are checked (version line, headers, lengths, end mark, digests
of block and payload). After a failed check inside a member the reader goes on with the next version line of its unpacked
bytes; where unpacking fails, or outside members, with the next gzip member or version line of the file. The
bytes between valid records are logged as a gap with the reason: by offset in the file, or in the unpacked bytes of
``member`` where other records of that member are kept. At most one record, as long as its header says, and one piece
of the file are held. What follows a place of a member that can't be unpacked is lost up to the next member.

Defined results: a null html is an empty payload; null page ids and addresses leave their header out (a page
without an id is never referred to); an address of more than ``LONGEST_URI`` bytes is named by its SHA-1 and stands in the block's HTTP
headers, since readers bound a record's own; rows that repeat id and payload are all ``response``; an empty table writes no file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.records import file_system
from tandem.session import store, work_folder

PIECE = 1 << 20
GZIP, VERSION = b"\x1f\x8b\x08", b"WARC/1."
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The date of every record; a given table has none.
DATE = "2000-01-01T00:00:00Z"

#: Bytes of an address in a record's headers, and of all its headers.
LONGEST_URI, LONGEST_HEADERS = 1 << 16, 1 << 20
_LOCATION = re.compile(rb"\r\nContent-Location: ([^\r\n]*)")

_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_END = b"\r\n\r\n"


class Damaged(ValueError):
    """Bytes that fail a check; the text is the reason."""


@dataclass
class Record:
    start: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP headers of the block."""
        return self.block.partition(_END)[2] if self.headers.get("content-type", "").startswith("application/http") else self.block


@dataclass
class Gap:
    """Bytes [start, end) that failed a check: of the file, or of what the gzip member at ``member`` unpacks to."""

    start: int
    end: int
    reasons: list[str] = field(default_factory=list)
    member: int | None = None


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_hex(label: str) -> str:
    """Lower-case hex of a ``sha1:`` label in base 32 or hex."""
    value = label.partition(":")[2]
    return value.lower() if len(value) == 40 else base64.b32decode(value).hex()


def page_name(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def record_bytes(headers: Iterable[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*headers, ("WARC-Block-Digest", sha1_label(block)), ("Content-Length", len(block))]]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + _END + block + _END


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Date", DATE)]
    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, hashlib.sha1(payload).hexdigest())}>" if page_id is None else page_name(page_id)
    headers += [("WARC-Record-ID", name)]
    if url is not None:
        uri = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url)
        if len(uri.encode()) > LONGEST_URI:
            http += b"\r\nContent-Location: " + uri.encode()
            uri = f"urn:sha1:{hashlib.sha1(uri.encode()).hexdigest()}"
        headers += [("WARC-Target-URI", uri)]
    http += _END
    headers += [("WARC-Payload-Digest", sha1_label(payload)), ("WARC-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        headers += [("WARC-Refers-To", page_name(refers_to)), ("WARC-Profile", REVISIT)]
    headers += [("Content-Type", "application/http; msgtype=response")]
    return record_bytes(headers, http if refers_to is not None else http + payload)


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Buffer:
    """Bytes from an iterator, taken from the front as a parser asks for them; those since ``begin`` can be given back."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held, self.at, self.mark, self.dropped = pieces, b"", 0, 0, 0

    @property
    def taken(self) -> int:
        return self.dropped + self.at

    def begin(self) -> None:
        self.mark = self.at

    def back(self) -> None:
        self.at = self.mark

    def fill(self, n: int) -> bool:
        """Whether n bytes are there to be taken; what lies before the mark is forgotten."""
        have = len(self.held) - self.at
        if have >= n:
            return True
        parts = []
        for piece in self.pieces:
            parts.append(piece)
            have += len(piece)
            if have >= n:
                break
        if parts:
            self.held = b"".join([self.held[self.mark :], *parts])
            self.dropped, self.at, self.mark = self.dropped + self.mark, self.at - self.mark, 0
        return have >= n

    def ended(self) -> bool:
        self.begin()
        return not self.fill(1)

    def take(self, n: int, what: str) -> bytes:
        if not self.fill(n):
            raise Damaged(f"{what} is cut short")
        out = self.held[self.at : self.at + n]
        self.at += n
        return out

    def take_until(self, mark: bytes, most: int, what: str) -> bytes:
        seen = 0
        while (found := self.held.find(mark, self.at + seen)) < 0:
            have = len(self.held) - self.at
            seen = max(0, have - len(mark) + 1)
            if have > most or not self.fill(have + 1):
                raise Damaged(f"{what} has no end")
        return self.take(found + len(mark) - self.at, what)

    def skip_to(self, mark: bytes) -> bool:
        """Go on to the next place after this one that begins with the mark, or to the end."""
        self.at += bool(self.fill(1))
        while (found := self.held.find(mark, self.at)) < 0:
            self.at = max(self.at, len(self.held) - len(mark) + 1)
            self.begin()
            if not self.fill(len(self.held) - self.at + 1):
                self.at = len(self.held)
                return False
        self.at = found
        return True


def parse_record(buffer: Buffer, start: int) -> Record:
    """The record at the front of the buffer; raises ``Damaged``."""
    head = buffer.take_until(_END, LONGEST_HEADERS, "header")
    line = _VERSION_LINE.match(head)
    if line is None:
        raise Damaged("no version line")
    headers: dict[str, str] = {}
    for part in head[line.end() : -4].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = part.partition(":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("no length")
    block = buffer.take(int(length), "block")
    if buffer.take(4, "end mark") != _END:
        raise Damaged("no end mark")
    record = Record(start, headers, block)
    _check(headers.get("warc-block-digest"), block, "block digest")
    if headers.get("warc-type") == "response":
        _check(headers.get("warc-payload-digest"), record.payload, "payload digest")
    return record


def _check(label: str | None, data: bytes, what: str) -> None:
    if label is None or not label.lower().startswith("sha1:"):
        return
    try:
        same = digest_hex(label) == hashlib.sha1(data).hexdigest()
    except ValueError:
        same = False
    if not same:
        raise Damaged(what)


def _pieces(file, at: int) -> Iterator[bytes]:
    file.seek(at)
    while piece := file.read(PIECE):
        yield piece


class _Member:
    """The bytes of one gzip member.

    ``end`` is known when all were taken; of a damaged one ``failed`` is the reason and ``reached`` the place in the file.
    """

    def __init__(self, file, start: int) -> None:
        self.file, self.start, self.end, self.failed, self.reached = file, start, None, None, start

    def __iter__(self) -> Iterator[bytes]:
        unpacker, at = zlib.decompressobj(31), self.start
        self.file.seek(at)
        while not unpacker.eof:
            piece = self.file.read(PIECE)
            if not piece:
                self.failed, self.reached = "gzip member is cut short", at
                return
            at += len(piece)
            before = unpacker.copy()
            try:
                rest = piece
                while rest and not unpacker.eof:
                    out = unpacker.decompress(rest, PIECE)
                    rest, before, piece = unpacker.unconsumed_tail, unpacker.copy(), unpacker.unconsumed_tail
                    if out:
                        yield out
            except zlib.error as why:
                self.reached = at - len(piece)
                yield from self._until_error(before, piece)
                self.failed = f"gzip: {why}"
                return
        self.end = at - len(unpacker.unused_data)

    def _until_error(self, unpacker, data: bytes, step: int = 256) -> Iterator[bytes]:
        """What data holds before the place that fails, which a single call doesn't give back."""
        for i in range(0, len(data), step):
            before, part = unpacker.copy(), data[i : i + step]
            try:
                out = unpacker.decompress(part)
            except zlib.error:
                if step > 1:
                    yield from self._until_error(before, part, 1)
                return
            self.reached += len(part)
            if out:
                yield out


def _next_start(file, at: int, size: int) -> int:
    """The next place that may begin a gzip member or a record, or the end of the file."""
    overlap = max(len(GZIP), len(VERSION)) - 1
    while at < size:
        file.seek(at)
        piece = file.read(PIECE)
        found = [i for i in (piece.find(GZIP), piece.find(VERSION)) if i >= 0]
        if found:
            return at + min(found)
        if at + len(piece) >= size:
            break
        at += len(piece) - overlap
    return size


def _member_items(source: _Member) -> Iterator[Record | Gap]:
    """All valid records of a gzip member and, by offset in its unpacked bytes, the gaps between them.

    A gap of length 0 at the end says that the member failed after a whole record.
    """
    buffer, gap = Buffer(iter(source)), None
    while not buffer.ended():
        try:
            record = parse_record(buffer, source.start)
        except Damaged as why:
            buffer.back()
            gap = gap or Gap(buffer.taken, 0, member=source.start)
            if str(why) not in gap.reasons:
                gap.reasons.append(str(why))
            buffer.skip_to(VERSION)
            gap.end = buffer.taken
            continue
        if gap is not None:
            yield gap
            gap = None
        yield record
    if source.failed is not None:
        gap = gap or Gap(buffer.taken, buffer.taken, member=source.start)
        gap.reasons.append(source.failed)
    if gap is not None:
        yield gap


def salvage(file, size: int) -> Iterator[Record | Gap]:
    """All valid records of a seekable file in order, and the gaps between them."""
    at, gap = 0, None
    while at < size:
        file.seek(at)
        if file.read(len(GZIP)) == GZIP:
            source, inner, kept = _Member(file, at), None, False
            for item in _member_items(source):
                if isinstance(item, Gap):
                    inner = item
                    continue
                if gap is not None:
                    yield gap
                    gap = None
                if inner is not None:
                    yield inner
                    inner = None
                kept = True
                # Reading on needs the file where the parser left it; a caller may not touch it in between.
                yield item
            bad, reasons = at, inner.reasons if inner else []
            at = _next_start(file, bad + 1, size) if source.failed else source.end
            if kept and inner is not None:
                if inner.end > inner.start:
                    yield inner
                bad, reasons = min(source.reached, at - 1), [source.failed] if source.failed else []
            if reasons:
                gap = gap or Gap(bad, at)
                gap.end = at
                gap.reasons += reasons
            continue
        buffer = Buffer(_pieces(file, at))
        reason, end = None, at
        try:
            while not buffer.ended():
                record = parse_record(buffer, at + buffer.taken)
                if gap is not None:
                    yield gap
                    gap = None
                yield record
                end = at + buffer.taken
        except Damaged as why:
            reason = str(why)
        if reason is None:
            at = size
            continue
        at = _next_start(file, end + 1, size)
        if gap is None:
            gap = Gap(end, at)
        gap.end = at
        gap.reasons.append(reason)
    if gap is not None:
        yield gap


MANIFEST = "path string, n_records long, n_bytes long"


def write_archives(pages: DataFrame, folder: str, revisit_from: int = 1000, file_bytes: int = 128 << 20) -> DataFrame:
    """Write a record for every page (``page_id, url, html``); returns the stored manifest."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), html.alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"), "digest": F.sha1(F.encode("html", "utf-8"))})
    # Written first, so that Spark knows the table's size when it plans the join: html is shuffled only if many repeat.
    shared = store(
        rows.where(F.col("size") >= revisit_from).groupBy("digest", "size")
        .agg(F.max("page_id").alias("named"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "warc-repeats",
    )
    named = F.when(F.col("named") > F.coalesce("page_id", F.col("named") - 1), F.col("named"))
    marked = rows.join(shared, ["digest", "size"], "left").withColumn("refers_to", named)
    marked = marked.select(
        F.col("page_id").isNotNull().alias("has_id"), F.coalesce("page_id", F.lit(0)).alias("page_id"), "url",
        F.encode("html", "utf-8").alias("payload"), F.col("refers_to").isNotNull().alias("again"),
        F.coalesce("refers_to", F.lit(0)).alias("refers_to"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        done, out, path, n, size = [], None, "", 0, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    path, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{path}", compression=None)
                data = gzip_member(
                    page_record(row.page_id if row.has_id else None, row.url, row.payload, row.refers_to if row.again else None)
                )
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        yield pd.DataFrame(done, columns=["path", "n_records", "n_bytes"])

    return store(marked.mapInPandas(run, MANIFEST), "warc-manifest")


READ = (
    "path string, member long, start long, stop long, reason string, page_id long, url string, record_type string,"
    " payload_bytes long, payload_digest string, refers_to long, payload binary"
)
_NAMES = [c.split()[0] for c in READ.split(",")]


def _address(record: Record) -> str | None:
    uri = record.headers.get("warc-target-uri")
    if uri and uri.startswith("urn:sha1:") and (found := _LOCATION.search(record.block, 0, record.block.find(_END))):
        return found[1].decode()
    return uri


_PAGE = re.compile(r"<urn:page:(-?\d+)>$")


def _page_of(name: str | None) -> int | None:
    found = _PAGE.match(name or "")
    return int(found[1]) if found else None


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False, whole: bool = False) -> DataFrame:
    """A row for each record, and one with a ``reason`` for each gap, of the files that a table names by ``path``.

    If they are to be ``whole``, a gap or a file with another number of records than the table's ``n_records`` fails the job.

    ``start`` and ``stop`` are offsets in the file, or, of a gap with a ``member``, in what the gzip member there unpacks to.

    Of a revisit the length and digest are those its headers give for the full payload.
    """

    def row_of(path: str, item: Record | Gap) -> tuple:
        if isinstance(item, Gap):
            reason = "; ".join(dict.fromkeys(item.reasons))
            return path, item.member, item.start, item.end, reason, None, None, None, None, None, None, None
        h, payload = item.headers, item.payload
        kind = h.get("warc-type")
        if kind == "revisit":
            size, digest = int(h.get("warc-payload-length") or 0), digest_hex(h.get("warc-payload-digest", ""))
        else:
            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        ids = _page_of(h.get("warc-record-id")), _page_of(h.get("warc-refers-to"))
        return path, None, item.start, None, None, ids[0], _address(item), kind, size, digest, ids[1], payload if with_payload else None

    def frame(rows: list[tuple]) -> pd.DataFrame:
        whole = dict.fromkeys(["member", "start", "stop", "page_id", "payload_bytes", "refers_to"], "Int64")
        return pd.DataFrame(rows, columns=_NAMES).astype(whole)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        for batch in batches:
            for path, n_records in zip(batch["path"], batch["n_records"], strict=True):
                size, seen = fs.get_file_info(f"{root}/{path}").size, 0
                with fs.open_input_file(f"{root}/{path}") as file:
                    rows, held = [], 0
                    for item in salvage(file, size):
                        if whole and isinstance(item, Gap):
                            raise Damaged(f"{path}: {'; '.join(item.reasons)}")
                        seen += isinstance(item, Record)
                        rows.append(row_of(path, item))
                        held += len(rows[-1][-1] or b"")
                        if len(rows) >= 2000 or held > 16 * PIECE:
                            yield frame(rows)
                            rows, held = [], 0
                    yield frame(rows)
                if whole and seen != n_records:
                    raise Damaged(f"{path}: {seen} records of {n_records}")

    counts = manifest if whole else manifest.withColumn("n_records", F.lit(-1))
    parallel = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return counts.select("path", "n_records").repartition(parallel, "path").mapInPandas(run, READ)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and return what each record says of its page."""
    folder = work_folder(pages.sparkSession, "warc")
    back = read_archives(write_archives(pages, folder), folder, whole=True)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
