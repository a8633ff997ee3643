import gzip
import hashlib
import random

import pytest

from tallyspark.llm import warc
from tallyspark.session import scratch_path


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("page_id", "url", "cast(coalesce(html, '') AS binary) AS payload")


def test_chunked_framing_round_trip():
    rng = random.Random(6)
    for n in (0, 1, 9, 10, 11, 1000):
        data = rng.randbytes(n)
        assert warc.unchunked(warc.chunked(data, 10)) == data
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")


@pytest.mark.parametrize("segment", [64, 700, 1 << 20])
def test_round_trip_with_segments(spark, segment):
    rng = random.Random(7)
    big = "é" + "".join(rng.choice("abc<>\r\n") for _ in range(5000))
    rows = [(1, "http://a/\nb", big), (2, None, None), (3, "u", ""), (4, "u", "x" * 999), (5, "u", "x" * 999),
            (6, "u", "y" * 1000), (9, "u", "y" * 1000), (8, "u", "y" * 1000), (9, "u", "y" * 1000),
            (None, "u", big), (11, "u", "WARC/1.1\r\n\r\n")]
    rows += [(100 + i, "v", "".join(rng.choice("pqr") for _ in range(rng.randint(0, 3000)))) for i in range(60)]
    path = scratch_path(spark, "warc-test")
    df = pages(spark, rows)
    warc.write_archives(warc.revisit_targets(df), path, segment_bytes=segment, chunk_bytes=333, records_per_file=7)
    back = warc.read_archives(spark, path)
    got = back.collect()
    assert len(got) == len(rows) and all(r.complete for r in got)
    texts = {i: (h or "") for i, _, h in rows}
    assert all(bytes(r.payload).decode() == texts[r.page_id] for r in got if r.record_type == "response")
    out = {(r.page_id, r.record_type): r for r in warc.resolved(back).collect()}
    for (page, _), r in out.items():
        assert r.payload_bytes == len(texts[page].encode())
        assert r.payload_digest == hashlib.sha1(texts[page].encode()).hexdigest()
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to) for r in got if r.page_id in (1, 4, 5, 6, 8, 9, None))
    assert kinds == [(-1, "revisit", 1), (1, "response", None), (4, "response", None), (5, "response", None),
                     (6, "revisit", 9), (8, "revisit", 9), (9, "response", None), (9, "response", None)]


def test_files_are_plain_gzip_archives(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.revisit_targets(pages(spark, [(1, "u", "a" * 5000), (2, "u", "b")])).coalesce(1), path, 1000)
    files = spark.read.format("binaryFile").load(path).collect()
    data = b"".join(gzip.decompress(bytes(f.content)) for f in files)
    assert data.count(b"WARC/1.1\r\n") == 7 and b"WARC-Segment-Total-Length: " in data


def test_broken_segments_are_reported():
    members = [*warc.page_records(1, "u", b"z" * 3000, None, "n", 1000, 100)]
    parts = [r for r in warc._records(b"".join(members))]
    good = warc.reassembled(parts)
    assert good.complete[0] and bytes(good.payload[0]) == b"z" * 3000
    assert not warc.reassembled(parts[:1] + parts[2:]).complete[0]
    assert not warc.reassembled(parts[:-1]).complete[0]


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.revisit_targets(pages(spark, [])), path)
    assert warc.resolved(warc.read_archives(spark, path)).count() == 0
