"""WARC archives: written, read back and compared with plain Python; damaged archives."""

import base64
import gzip
import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from veilcount.llm import warc
from veilcount.operators import skew

SCHEMA = "page_id long, url string, html string, digest string, refers_to int, value string"


def page_rows():
    big = "".join(hashlib.sha256(str(at).encode()).hexdigest() for at in range(3000))
    rows = [(at, f"http://h{at}.org/é?q={at}", f"<p>{at % 40}</p>") for at in range(200, 0, -1)]
    rows += [(1000 + at, None, "copied") for at in range(300)]  # one payload is most of what there is
    rows += [(500, "http://x/\r\nInjected: y", big), (501, "u", big), (7, "again", "<p>7</p>"), (47, "again", "<p>7</p>")]
    rows += [(600, "n", None), (601, "", ""), (None, "nobody", "only nulls"), (None, "nobody", "only nulls"), (None, "z", "copied")]
    rows += [(700, "crlf", "\r\n\r\n"), (701, "w", "WARC/1.1\r\n\r\n"), (702, "zero", "\x00 \x1f"), (703, "wide", "漢字 😀" * 50)]
    return [(page_id, url, html, "x", 1, "y") for page_id, url, html in rows]


def plain(rows, least=0):
    smallest = defaultdict(lambda: None)
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            best = smallest[html or ""]
            smallest[html or ""] = page_id if best is None else min(best, page_id)
    found = []
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        first = smallest[html or ""]
        again = page_id != first and len(payload) >= least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        found.append((page_id, len(payload), digest, "revisit" if again else "response", first if again else None))
    return Counter(found)


def test_archives_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 50)
    monkeypatch.setattr(skew, "SMALLEST_HEAVY", 20)  # the frequent payload is spread
    rows = page_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = [tuple(row) for row in warc.report(frame).collect()]
    assert Counter(found) == plain(rows)

    warc.write_archives(frame, str(tmp_path / "out"), least=8)
    read = warc.read_archives(spark, str(tmp_path / "out"), keep_payload=True)
    kept = read.collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in kept) == plain(rows, 8)
    assert all(r.verified for r in kept)
    texts = defaultdict(set)
    for page_id, _, html, *_ in rows:
        texts[page_id].add((html or "").encode())
    assert all(bytes(r.payload) in texts[r.page_id] if r.record_type == "response" else r.payload is None for r in kept)
    assert {r.url for r in kept if r.page_id == 500} == {"http://x/%0D%0AInjected:%20y"}

    # The files are archives to any reader of gzip, with as many members as rows.
    archives = [path.read_bytes() for path in Path(tmp_path / "out").glob("part-*")]
    assert sum(gzip.decompress(archive).count(b"WARC-Record-ID: ") for archive in archives) == len(rows)
    assert all(archive[-1] == 0 for archive in archives) and len(archives) > 4


def test_no_pages(spark):
    assert warc.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_record_whose_size_ends_in_another_byte():
    content = warc.record(1, "u", b"a" * (1 << 24), None)
    packed = warc.member(content)
    assert packed[-1] == 0 and zlib.decompress(packed, 31) == content
    ((fields, sums),) = warc.read_records(packed + warc.member(b""))
    assert warc.described(fields, sums)["payload_bytes"] == 1 << 24 and warc.described(fields, sums)["verified"]


def test_records_are_read_in_pieces(monkeypatch):
    payloads = [b"", b"x", b"\r\n\r\n" * 9, b"y" * 5000, bytes(range(256)) * 20]
    archive = b"".join(warc.member(warc.record(at, None, payload, None)) for at, payload in enumerate(payloads))
    for piece in (1, 2, 3, 7, 100, 1 << 16):
        monkeypatch.setattr(warc, "PIECE", piece)
        read = [warc.described(fields, sums) for fields, sums in warc.read_records(archive, keep=True)]
        assert [row["payload"] for row in read] == payloads
        assert [row["page_id"] for row in read] == [0, 1, 2, 3, 4] and all(row["verified"] for row in read)


def test_damage_is_noticed():
    whole = warc.record(1, "u", b"some text", None)
    for broken in (
        whole.replace(b"Content-Length: 9", b"Content-Length: 8"),
        whole.replace(b"some", b"same"),
        warc.record(2, "u", b"some text", 1).replace(b"sha1:", b"sha1:A"),
    ):
        ((fields, sums),) = warc.read_records(warc.member(broken))
        assert not warc.described(fields, sums)["verified"]
    packed = warc.member(whole)
    for archive in (packed[:-9], packed[:30], warc.member(whole[:-1]), warc.member(whole + b"x"), warc.member(b"x" + whole), warc.member(whole[:40])):
        with pytest.raises(ValueError):
            list(warc.read_records(archive))
    with pytest.raises(zlib.error):
        list(warc.read_records(packed[:-8] + b"\x00" * 8))
    assert list(warc.read_records(b"")) == []
