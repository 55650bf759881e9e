from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from cashloom.llm import queries
from cashloom.llm.warc import members, page_member, parsed, read_archives, write_archives


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, least=0):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[(html or "").encode()].append(i)
    out = []
    for data, ids in groups.items():
        best = max(ids, key=lambda i: (i is not None, i or 0))
        seen = False
        for i in ids:
            response = len(ids) == 1 or len(data) < least or (i == best and not seen)
            seen |= i == best
            out.append((i, len(data), b32(data), "response" if response else "revisit", None if response else best))
    return sorted(out, key=str)


def rows():
    base = [(i, f"http://e.com/{i}", f"<p>{'x' * (i * 37 % 400)}</p>") for i in range(300)]
    return base + [
        (1000, None, None), (1001, "http://a b/\r\nX: 1", ""), (None, "http://n/", "<p></p>"), (None, None, None),
        (1002, "http://é/", "é\U0001f600\r\n\r\nWARC/1.1"), (1003, "u", "y" * 3_000_000), (5, "http://e.com/5", base[5][2]), (2000, "v", "dup"), (2000, "v", "dup"), (-7, "w", "dup"),
    ]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, 1, 2) for r in rows()], "page_id long, url string, html string, shard int, tie int")


@pytest.mark.parametrize("least", [0, 50])
def test_round_trip(spark, pages, tmp_path, least):
    folder = f"file://{tmp_path}/a"
    write_archives(pages, folder, least_bytes=least, shard_bytes=20_000, roll_bytes=3000)
    got = read_archives(spark, folder, payloads=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows(), least)
    by_id = {r.record_id: r for r in got}
    assert len(by_id) == len(got)
    html = Counter((r.page_id, bytes(r.payload)) for r in got if r.record_type == "response")
    wanted = Counter((i, (h or "").encode()) for i, _, h in rows())
    assert not html - wanted and all(b32(p) for _, p in html)


def files(folder: Path):
    return {p.name: p.read_bytes() for p in sorted(folder.glob("*.warc.gz"))}


def test_same_bytes_whatever_the_partitions(spark, pages, tmp_path):
    write_archives(pages.repartition(1), f"file://{tmp_path}/a", shard_bytes=20_000, roll_bytes=3000)
    manifest = write_archives(pages.repartition(7, "url"), f"file://{tmp_path}/b", shard_bytes=20_000, roll_bytes=3000)
    first, second = files(tmp_path / "a"), files(tmp_path / "b")
    assert first == second and len(first) > 5
    assert {r.name: r.sha1 for r in manifest.collect()} == {n: hashlib.sha1(d).hexdigest() for n, d in second.items()}
    assert not (tmp_path / "b" / "temporary").exists()
    ids = []
    for data in first.values():
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        assert len(data) < 3000 or len([1 for r in gzip_records(data)]) >= 1
        ids += [r["page_id"] for r in gzip_records(data) if r]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def gzip_records(data):
    import io

    return [parsed(m) for m in members(io.BytesIO(data), 100)]


def test_damage_is_noticed():
    member = page_member(1, "u", b"payload", None, 0, "2024-01-01T00:00:00Z")
    record = gzip.decompress(member)
    assert parsed(record)["payload"] == b"payload"
    for old, new in [(b"payload", b"paylaod"), (b"WARC/1.1", b"WARC/0.9")]:
        with pytest.raises((ValueError, KeyError)):
            parsed(record.replace(old, new))
    with pytest.raises(ValueError):
        import io

        list(members(io.BytesIO(member[:-9])))


def test_empty_table(spark, pages, tmp_path):
    assert write_archives(pages.limit(0), f"file://{tmp_path}/e").count() == 0
    assert read_archives(spark, f"file://{tmp_path}/e").count() == 0


def test_query_against_brute_force(spark, middle):
    given = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{middle}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op9_warc(spark, middle).collect()), key=str) == expected(given)
