"""Archives against Python's own gzip and hashes, ranges that cut records anywhere, damaged files."""

import gzip
import hashlib
import os
import random
import zlib

import pytest

from millrace.llm import warc
from millrace.session import full_uri, run_folder

SCHEMA = "page_id long, url string, html string, file string, digest string, head string, payload string"


def frame(spark, pages):
    return spark.createDataFrame([(*p, "f", "d", "h", "p") for p in pages], SCHEMA)


def place(spark):
    return full_uri(spark, run_folder(spark, "warc-test"))


def web(count, seed=1):
    draw = random.Random(seed)
    copies = ["<p>" + "".join(draw.choices("abc é中", k=2000)) for _ in range(3)]
    out = []
    for k in range(count):
        body = draw.choice(copies) if k % 3 else "".join(draw.choices("xyz <>\r\n", k=draw.choice([0, 5, 999, 1000, 5000])))
        out.append((k, f"https://example.com/{k}?q=a b&é=1", body))
    return out


def expected(pages):
    bodies = [(k, (html or "").encode()) for k, _, html in pages]
    heads = {}
    for k, body in bodies:
        if len(body) >= 1000 and k is not None:
            heads[body] = max(heads.get(body, k), k)
    out = []
    for k, body in bodies:
        head = heads.get(body)
        visit = head is not None and k != head
        out.append((k, "revisit" if visit else "response", len(body), hashlib.sha1(body).hexdigest(), head if visit else None))
    return sorted(out, key=repr)


def archived(spark, pages, split_bytes=warc.SPLIT_BYTES, **options):
    folder = place(spark)
    warc.write_warc(frame(spark, pages).repartition(3), folder, **options)
    return folder, rows(warc.archived_pages(warc.read_warc(spark, folder, split_bytes=split_bytes)))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("split_bytes", [97, 1000, 1 << 26])
def test_what_is_written_is_read_back(spark, split_bytes):
    pages = web(90)
    assert archived(spark, pages, split_bytes)[1] == expected(pages)


def test_odd_pages(spark):
    long_one = "long " * 400_000
    pages = [(1, None, None), (2, "", ""), (2, "", ""), (3, "no url\r\nat all", long_one), (4, "u", long_one)]
    pages += [(None, "x", "known " * 500), (5, "x", "known " * 500), (None, "y", "alone " * 500), (5, "x", "known " * 500)]
    pages += [(6, "z", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc" * 30)]
    assert archived(spark, pages, 501)[1] == expected(pages)
    assert archived(spark, [])[1] == []


def test_files_are_plain_archives(spark):
    """Python's gzip sees the same records, and small files roll over."""
    pages = web(60, seed=2)
    folder, _ = archived(spark, pages, file_bytes=4000)
    path = folder.removeprefix("file:").replace("//", "/")
    names = [n for n in os.listdir(path) if n.endswith(".warc.gz")]
    text = b"".join(gzip.open(f"{path}/{n}").read() for n in names)
    assert len(names) > 3 and text.count(b"WARC/1.1\r\n") == len(names) + 60
    assert text.count(b"WARC-Type: revisit") == sum(e[1] == "revisit" for e in expected(pages))


def test_payloads_come_back_whole(spark):
    pages = web(40, seed=3)
    folder, _ = archived(spark, pages)
    index = warc.read_warc(spark, folder, split_bytes=3000)
    got = warc.with_payloads(index.where("record_type = 'response'")).collect()
    bodies = {warc.urn_key(r.record_id): bytes(r.payload) for r in got}
    for k, kind, *_ in expected(pages):
        if kind == "response":
            assert bodies[str(k)] == dict((p[0], p[2]) for p in pages)[k].encode()


def stored(fields, block):
    """A record in a gzip member that is not compressed, so that its bytes stand in the file."""
    press = zlib.compressobj(0, zlib.DEFLATED, 31)
    head = "\r\n".join(["WARC/1.0", *fields, f"Content-Length: {len(block)}", "", ""]).encode()
    return press.compress(head + block + b"\r\n\r\n") + press.flush()


def foreign(spark, tmp_path, data):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.warc.gz").write_bytes(data)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    return "file://" + str(tmp_path)


def by_offset(df):
    return sorted((r.offset, r.length, r.record_id, r.payload_bytes, r.damaged) for r in df.collect())


@pytest.mark.parametrize("split_bytes", [64, 301, 10_000])
def test_a_record_inside_a_payload_is_no_record(spark, tmp_path, split_bytes):
    inner = stored(["WARC-Type: resource", "WARC-Record-ID: <inner>"], b"i" * 200)
    parts = [
        stored(["WARC-Type: resource", "WARC-Record-ID: <a>", "Content-Type: text/plain"], warc.GZIP_MAGIC * 50),
        stored(["WARC-Type: resource", "WARC-Record-ID: <b>"], b"x" * 300 + inner * 3),
        stored(["WARC-Type: metadata", "WARC-Record-ID:", " <c>"], b""),
    ]
    folder, starts = foreign(spark, tmp_path, b"".join(parts)), [0, len(parts[0]), len(parts[0] + parts[1])]
    got = by_offset(warc.read_warc(spark, folder, split_bytes=split_bytes))
    sizes = [150, 300 + 3 * len(inner), 0]
    ids = ["<a>", "<b>", "<c>"]
    assert got == [(s, len(p), i, n, False) for s, p, i, n in zip(starts, parts, ids, sizes, strict=True)]


def test_damaged_records_are_marked(spark, tmp_path):
    whole = [warc.page_record(k, "u", b"body" * 400, "00" * 20, None, False, warc.DATE) for k in range(3)]
    broken = bytearray(whole[1])
    broken[-6] ^= 1  # the checksum
    data = whole[0] + b"junk" + bytes(broken) + whole[2] + whole[0][:150]
    got = by_offset(warc.read_warc(spark, foreign(spark, tmp_path, data), split_bytes=200))
    assert [(g[2], g[3], g[4]) for g in got[:3]] == [
        ("<urn:record:k-0>", 1600, False), ("<urn:record:k-1>", None, True), ("<urn:record:k-2>", 1600, False),
    ]
    assert all(g[4] for g in got[3:])


def test_files_of_lost_tasks_are_not_read(spark):
    pages = web(20, seed=4)
    folder, before = archived(spark, pages)
    path = folder.removeprefix("file:").replace("//", "/")
    with open(f"{path}/{'0' * 32}.warc.gz", "wb") as stray:
        stray.write(warc.page_record(99, "u", b"stray", "00" * 20, None, False, warc.DATE))
    assert rows(warc.archived_pages(warc.read_warc(spark, folder))) == before


def test_revisits_of_nothing(spark, tmp_path):
    digest = hashlib.sha1(b"gone").hexdigest()
    data = warc.page_record(1, "u", b"gone", digest, 7, True, warc.DATE)
    data += warc.page_record(7, "u", b"other", hashlib.sha1(b"other").hexdigest(), None, False, warc.DATE)
    got = rows(warc.archived_pages(warc.read_warc(spark, foreign(spark, tmp_path, data))))
    assert got == [(1, "revisit", None, None, 7), (7, "response", 5, hashlib.sha1(b"other").hexdigest(), None)]


@pytest.mark.parametrize("key", [None, 12, "a b/ü>%", "", "none"])
def test_keys_survive_as_urns(key):
    assert warc.urn_key(warc.record_urn(key)) == (None if key is None else str(key))
