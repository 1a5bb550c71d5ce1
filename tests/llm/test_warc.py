import base64
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from leafline.llm import warc
from leafline.llm.common import new_folder

PAGES = "page_id long, url string, html string, record_id string, payload string, block string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x", "x") for i, u, h in rows], PAGES)


ROWS = [
    (1, "http://a.org/1", "<p>one</p>"), (2, "http://a.org/2", "<p>one</p>"), (3, None, None), (4, "http://b.org", ""),
    (5, "http://c.org/é", "<p>" + "ü漢😀" * 40_000 + "</p>"), (6, "x\r\nWARC-Type: evil", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"),
    (7, "http://d.org", "0\r\n\r\n"), (None, "http://e.org", "<p>one</p>"), (8, "http://f.org", "same"), (8, "http://f.org", "same"),
]


def round_trip(spark, rows, **sizes):
    planned = warc.plan_records(pages(spark, rows))
    path = new_folder(spark, "test-warc")
    warc.write_archives(planned, path, **sizes)
    return planned, warc.read_archives(spark, path)


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 7, "segment_bytes": 100, "records_per_file": 50}])
def test_round_trip(spark, sizes):
    rows = ROWS if not sizes else [r for r in ROWS if r[0] != 5]
    planned, records = round_trip(spark, rows, **sizes)
    records = records.cache()
    got = {bytes(r["payload"]) for r in warc.read_payloads(records).collect()}
    assert got == {(h or "").encode() for _, _, h in rows}
    if sizes:
        assert records.where("record_type = 'continuation'").count() > 0
    heads = records.where("record_type in ('response', 'revisit')")
    assert heads.count() == len(rows)


def test_types_and_digests(spark):
    groups = defaultdict(list)
    for i, _, h in ROWS:
        groups[(h or "").encode()].append(i)
    for r in warc.plan_records(pages(spark, ROWS)).collect():
        p = bytes(r["payload"])
        top = max((i for i in groups[p] if i is not None), default=None)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(p).digest()).decode()
        assert r["payload_bytes"] == len(p)
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["page_id"] == top else ("revisit", top))


def test_a_lost_segment_is_an_error(spark):
    _, records = round_trip(spark, [(1, "http://a.org", "x" * 5000)], chunk_bytes=100, segment_bytes=500)
    cut = records.where(F.coalesce("segment_number", F.lit(1)) != 3)
    assert not warc.reassemble(cut).first()["complete"]
    with pytest.raises(Exception, match="segments missing"):
        warc.read_payloads(cut).collect()


def test_damaged_frames():
    with pytest.raises(ValueError):
        warc.dechunk(b"5\r\nabc")
    assert warc.dechunk(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"))


def test_empty(spark):
    _, records = round_trip(spark, [])
    assert records.count() == 0 and warc.read_payloads(records).count() == 0
