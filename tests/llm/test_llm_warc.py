"""Archives that are read back whole, and archives with bytes changed, lost or added."""

from __future__ import annotations

import gzip
import hashlib
import io

import pytest

from tandem.llm import warc as W
from tandem.llm.records import file_system
from tandem.session import work_folder

PAGES = "page_id long, url string, html string"


def salvaged(data):
    items = list(W.salvage(io.BytesIO(data), len(data)))
    return [W._page_of(i.headers["warc-record-id"]) for i in items if isinstance(i, W.Record)], [i for i in items if isinstance(i, W.Gap)]


def records(n=6, size=3000):
    return [W.page_record(i, f"http://x/{i}", bytes([65 + i]) * size + b"\r\n\r\n" + hashlib.sha256(bytes([i])).digest() * 40, None) for i in range(n)]


@pytest.mark.parametrize("pack", [W.gzip_member, lambda r: r])
def test_whole_archives(pack):
    data = b"".join(map(pack, records()))
    ids, gaps = salvaged(data)
    assert ids == [0, 1, 2, 3, 4, 5] and not gaps
    assert [r.payload[:3] for r in W.salvage(io.BytesIO(data), len(data))] == [bytes([65 + i]) * 3 for i in range(6)]


@pytest.mark.parametrize("pack", [W.gzip_member, lambda r: r])
def test_a_changed_byte_costs_one_record(pack):
    parts = [pack(r) for r in records()]
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    data = bytearray(b"".join(parts))
    data[starts[2] + len(parts[2]) * 2 // 3] ^= 0x55
    ids, gaps = salvaged(bytes(data))
    assert ids == [0, 1, 3, 4, 5]
    assert [(g.start, g.end) for g in gaps] == [(starts[2], starts[3])] and gaps[0].reasons


@pytest.mark.parametrize("pack", [W.gzip_member, lambda r: r])
def test_lost_ends_beginnings_and_bytes_between(pack):
    parts = [pack(r) for r in records()]
    junk = b"\x00junk \x1f\x8b\x08 not a member WARC/1.0 not a record" * 3
    ids, gaps = salvaged(junk + parts[0] + junk + parts[1][:-40] + parts[2] + parts[3] + parts[4][:50])
    assert ids == [0, 2, 3]
    assert len(gaps) == 3 and gaps[0].start == 0 and gaps[0].end == len(junk)
    assert gaps[-1].end == len(junk) * 2 + sum(map(len, parts[:1] + parts[2:4])) + len(parts[1]) - 40 + 50
    assert salvaged(b"") == ([], []) and salvaged(junk)[0] == []


def test_records_before_the_damage_of_a_shared_member_are_kept():
    data = bytearray(gzip.compress(b"".join(records(5)), mtime=0))
    data[-1] ^= 1  # the length check of the member
    ids, gaps = salvaged(bytes(data) + W.gzip_member(records()[5]))
    assert ids == [0, 1, 2, 3, 4, 5] and len(gaps) == 1


def test_pages_and_what_the_archives_say_of_them(spark):
    same, short = "é" * 600, "s" * 999
    rows = [(1, "http://a/", same), (2, None, same), (7, "u", same), (3, "u", short), (4, "u", short), (5, "u", None), (6, "u\r\nX: y", ""),
            (None, "u", same), (8, "u", "b" * 1000), (8, "u", "b" * 1000), (None, "u", "c" * 2000), (9, "u", "d" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", digest string")
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode())
    again = {1: 7, 2: 7}
    expected = []
    for i, _, html in rows:
        to = again.get(i) if i is not None else (7 if html == same else None)
        expected.append((i, size(html), digest(html), "revisit" if to else "response", to))
    got = W.archive_and_read(pages)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert W.archive_and_read(pages.where("false")).count() == 0


def test_small_files_payloads_and_gaps_of_stored_archives(spark):
    pages = spark.createDataFrame([(i, f"http://p/{i}", f"<p>{i}</p>" * 50) for i in range(30)], PAGES).coalesce(2)
    folder = work_folder(spark, "warc-test")
    manifest = W.write_archives(pages, folder, file_bytes=1500)
    assert manifest.count() > 4
    back = W.read_archives(manifest, folder, with_payload=True)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in back.collect()} == {(i, f"<p>{i}</p>" * 50) for i in range(30)}
    fs, root = file_system(folder)
    path = f"{root}/{manifest.first()['path']}"
    with fs.open_input_file(path) as file:
        data = bytearray(file.read())
    data[len(data) // 2] ^= 0xFF
    with fs.open_output_stream(path, compression=None) as out:
        out.write(bytes(data))
    again = W.read_archives(manifest, folder)
    assert again.where("reason is null").count() == 29
    assert [r["stop"] > r["start"] for r in again.where("reason is not null").collect()] == [True]


def test_records_after_the_damage_inside_a_shared_member_are_kept():
    parts = records(6)
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    wrong = {1: parts[1][:-900] + b"?" + parts[1][-899:], 3: parts[3].replace(b"Content-Length: ", b"Content-Length: 9"), 5: parts[5][:-3]}
    for bad in ([1], [3], [0], [5], [1, 3], [2, 3], [1, 3, 5]):
        told = [wrong.get(i, b"junk" + p[4:]) if i in bad else p for i, p in enumerate(parts)]
        data = b"".join(told)
        at = [sum(map(len, told[:i])) for i in range(7)]
        ids, gaps = salvaged(W.gzip_member(data) + W.gzip_member(records(7)[6]))
        assert ids == [i for i in range(7) if i not in bad], bad
        runs = [(i, i + 1) for i in bad] if bad != [2, 3] else [(2, 4)]
        assert [(g.member, g.start, g.end) for g in gaps] == [(0, at[a], at[b]) for a, b in runs]
    # Damage by digest, then a member that can't be unpacked to its end: both are logged, no record twice.
    broken = bytearray(W.gzip_member(b"".join([parts[0], wrong[1], *parts[2:]])))
    broken[-1] ^= 1
    ids, gaps = salvaged(bytes(broken) + W.gzip_member(records(7)[6]))
    assert ids == [0, 2, 3, 4, 5, 6]
    assert [(g.member, g.start) for g in gaps[:1]] == [(0, starts[1])]
    assert gaps[1].member is None and gaps[1].end == len(broken) and len(gaps) == 2


def test_version_lines_across_pieces_and_a_long_member(monkeypatch):
    monkeypatch.setattr(W, "PIECE", 37)
    parts = records(5, size=300)
    parts[1] = parts[1][:400] + b"?" + parts[1][401:]
    assert salvaged(W.gzip_member(b"".join(parts)))[0] == [0, 2, 3, 4]


def test_long_addresses_and_lost_records(spark, tmp_path):
    long_url = "http://a.b/" + "é" * 700_000 + "\r\nx"
    rows = [(1, long_url, "one"), (2, "http://a.b/", "two" * 500), (3, long_url, "two" * 500), (4, "urn:sha1:00", "four")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = str(tmp_path / "warc")
    manifest = W.write_archives(pages, folder)
    found = {r["page_id"]: (r["url"], r["record_type"]) for r in W.read_archives(manifest, folder, whole=True).collect()}
    kept = long_url.replace("\r\n", "%0D%0A")
    assert found == {1: (kept, "response"), 2: ("http://a.b/", "revisit"), 3: (kept, "response"), 4: ("urn:sha1:00", "response")}
    more = manifest.withColumn("n_records", manifest["n_records"] + 1)
    with pytest.raises(Exception, match="4 records of 5"):
        W.read_archives(more, folder, whole=True).collect()
    path = manifest.first()["path"]
    data = bytearray((tmp_path / "warc" / path).read_bytes())
    data[len(data) // 2] ^= 255
    (tmp_path / "warc" / path).write_bytes(data)
    with pytest.raises(Exception, match=path):
        W.read_archives(manifest, folder, whole=True).collect()
