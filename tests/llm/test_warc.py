import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from topicloom.llm import warc


def record(page, payload, digest=True):
    sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: {page}\r\nWARC-Target-URI: http://x/{page}\r\n"
    head += f"WARC-Payload-Digest: sha1:{sha}\r\n" if digest else ""
    return (head + f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload + b"\r\n\r\n"


def kinds(data):
    out = []
    for kind, position, a, b in warc.salvage(data):
        out.append((kind, position, int(a[b"x-page-id"]), b) if kind == "record" else (kind, position, a, b))
    return out


def test_clean_and_empty():
    data = b"".join(record(i, b"p" * i) for i in range(4))
    assert [(k, p) for k, _, p, _ in kinds(data)] == [("record", i) for i in range(4)]
    assert kinds(b"") == []


@pytest.mark.parametrize("compress", [False, True])
def test_damage_is_quarantined_and_later_records_recovered(compress):
    parts = [record(i, bytes(str(i) * 400, "ascii")) for i in range(6)]
    pack = [gzip.compress(p) if compress else p for p in parts]
    starts = [sum(map(len, pack[:i])) for i in range(7)]
    bad = bytearray(b"".join(pack))
    middle = starts[2] + len(pack[2]) - 12
    bad[middle : middle + 3] = b"\x00\x01\x02"
    found = kinds(bytes(bad))
    assert [p for k, _, p, _ in found if k == "record"] == [0, 1, 3, 4, 5]
    (gap,) = [f for f in found if f[0] == "gap"]
    assert gap[1] == starts[2] and gap[2] == len(pack[2])


def test_truncated_tail_and_leading_junk():
    data = b"junk" + record(1, b"abc") + record(2, b"x" * 100)[:60]
    found = kinds(data)
    assert found[0][:3] == ("gap", 0, 4) and found[1][0] == "record" and found[2][0] == "gap"
    assert found[2][1] + found[2][2] == len(data)
    lying = record(1, b"abc").replace(b"Content-Length: 3", b"Content-Length: 9") + record(2, b"d")
    assert [f[2] for f in kinds(lying) if f[0] == "record"] == [2]


def test_version_line_inside_a_payload():
    data = record(1, b"a\r\nWARC/1.1\r\nb") + record(2, b"")
    assert [f[2] for f in kinds(data)] == [1, 2]


@pytest.mark.parametrize("compress", [False, True])
def test_round_trip_with_revisits_and_edges(spark, tmp_path, compress):
    pages = [(1, "u", "same"), (2, None, "same"), (3, "a\r\nb", "same"), (4, "u", None), (5, "u", ""), (None, "u", "same"),
             (6, "u", "tie"), (6, "u", "tie"), (7, "u", "é" * 100_000)]
    table = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, _id string, _digest string")
    path = f"{tmp_path}/w{compress}"
    warc.write_archives(table, path, compress=compress)
    back = warc.read_archives(spark, path)
    rows = back.collect()
    assert len(rows) == len(pages) and warc.gaps(back).count() == 0
    got = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows}
    assert {(1, "revisit", 3, 4), (2, "revisit", 3, 4), (3, "response", None, 4), (4, "revisit", 5, 0)} <= got
    assert {(5, "response", None, 0), (None, "response", None, 4), (6, "response", None, 3)} <= got
    stored = {r["page_id"]: bytes(r["payload"]) for r in rows if r["record_type"] == "response"}
    assert stored[7] == ("é" * 100_000).encode() and stored[3] == b"same"
    sha = base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    assert all(r["payload_digest"] == sha for r in rows if r["payload_bytes"] == 4)
    warc.write_archives(table.limit(0), f"{path}-none", compress=compress)
    assert warc.read_archives(spark, f"{path}-none").count() == 0


def test_minimum_size(spark):
    rows = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "_id long, _url string, _html string")
    got = {r["_id"]: r["_type"] for r in warc.with_revisits(rows, min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert rows.select(warc.base32_sha1(F.lit("a").cast("binary"))).first()[0] == base64.b32encode(hashlib.sha1(b"a").digest()).decode()
