"""WARC archives: round trips, revisits, and byte ranges."""

import gzip
import hashlib
import random

import pyarrow as pa
import pytest

from sensormart.llm import warc


def _brute(rows):
    first = {}
    for page_id, html in rows:
        payload = (html or "").encode()
        if page_id is not None and len(payload) >= 100:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, html in rows:
        payload = (html or "").encode()
        to = first.get(payload)
        to = None if to == page_id else to
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def _check(pages, split_bytes):
    rows = [(r.page_id, r.html) for r in pages.select("page_id", "html").collect()]
    read = warc.read_warc(warc.write_warc(pages), split_bytes).drop("payload").collect()
    assert sorted((tuple(r) for r in read), key=str) == _brute(rows)


@pytest.mark.parametrize("split_bytes", [1 << 20, 700])
def test_round_trip(spark, sf_dir, split_bytes):
    _check(spark.read.parquet(f"{sf_dir}/pages.parquet"), split_bytes)
    long, other = "<p>" * 60, "é" * 50
    rows = [(5, long), (3, long), (4, long), (3, long), (None, long), (None, other), (7, None), (8, ""), (9, "x" * 99)]
    rows += [(10, "x" * 99), (11, other), (12, "y" * 300_000), (13, "WARC/1.1\r\n\r\n"), (None, None)]
    odd = spark.createDataFrame([(*r, "u", 1) for r in rows], "page_id long, html string, digest string, size int")
    _check(odd, split_bytes)
    _check(odd.limit(0), split_bytes)


def test_ranges_own_each_record_once(tmp_path):
    rng = random.Random(2)
    inner = b"".join(warc.encode_record(i, "", b"in" * 9, "", 0) for i in range(3))
    payloads = [rng.randbytes(rng.randint(0, 3000)) for _ in range(60)] + [inner, b"a" * 9, warc.MAGIC * 50, inner]
    data = b""
    for i, payload in enumerate(payloads):
        head = f"WARC/1.1\r\nContent-Length: {len(payload)}\r\nN: {i}\r\n\r\n".encode()
        data += gzip.compress(head + payload + b"\r\n\r\n", compresslevel=rng.choice([0, 6]))
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    stream = pa.OSFile(str(path))
    for split in (5000, 17_000, 1 << 20):
        found = [
            int(warc._fields(r.partition(b"\r\n\r\n")[0])["n"])
            for start in range(0, len(data), split)
            for r in warc.read_range(stream, len(data), start, start + split)
        ]
        assert found == list(range(len(payloads)))


def test_damage_is_not_passed_over(tmp_path):
    members = [warc.encode_record(i, "", random.Random(i).randbytes(500), "", None) for i in range(3)]
    data = bytearray(b"".join(members))
    data[len(members[0]) + len(members[1]) - 6] ^= 255
    (tmp_path / "x").write_bytes(data)
    with pytest.raises(ValueError):
        list(warc.read_range(pa.OSFile(str(tmp_path / "x")), len(data), 0, len(data)))
