"""WARC bundles: round trip, seek table, revisits, fetching by the index."""

import hashlib
import io

import zstandard
from llm_helpers import clashing

from demandcast.llm import warc as W
from demandcast.llm.common import Scratch

LONG = "é" * 600


def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i * 20)) for i in range(1, 60)]
    rows += [(100, "http://h/a b\r\nX: y", LONG), (101, None, LONG), (102, "u", LONG), (None, "u", LONG), (102, "u2", LONG), (103, "u", "short"), (104, "u", "short"),
             (105, "u", None), (106, "u", ""), (107, "u", "a\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "x" * 2000)]
    return rows, clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_round_trip(spark, monkeypatch):
    rows, df = pages(spark)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        twin = html == LONG and i != 102
        want.append((i or -1, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if twin else "response", 102 if twin else -1))
    for frame, bundle in ((256 << 10, 8 << 20), (500, 1500)):
        monkeypatch.setattr(W, "FRAME_BYTES", frame)
        monkeypatch.setattr(W, "BUNDLE_BYTES", bundle)
        bundles = W.build(df, Scratch(spark, "t"))
        got = sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1) for r in W.read(bundles).collect())
        assert got == sorted(want)


def test_index_and_plain_archive(spark):
    rows, df = pages(spark)
    bundles = W.build(df, Scratch(spark, "t"))
    places = W.index(bundles).collect()
    assert len(places) == len(rows)
    for b in bundles.collect():
        frames = W.frames_of(b.data)
        plain = [zstandard.ZstdDecompressor().decompress(b.data[s:s + c], max_output_size=n) for s, c, n in frames]
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(b.data), read_across_frames=True) as whole:
            assert whole.read() == b"".join(plain)  # the seek table is skipped
        for p in places:
            if p.bundle == b.bundle:
                headers, _, end = W.parse(plain[p.frame], p.offset)
                assert headers["WARC-Record-ID"] == f"<urn:page:{'' if p.record_id is None else p.record_id}>" and end == p.offset + p.length


def test_fetch_reads_wanted_records(spark):
    rows, df = pages(spark)
    bundles = W.build(df, Scratch(spark, "t"))
    wanted = spark.createDataFrame([(3,), (100,), (107,), (999,), (None,)], "page_id long")
    got = {r.page_id: bytes(r.payload) for r in W.fetch(bundles, wanted).collect()}
    texts = {i: (t or "").encode() for i, _, t in rows}
    assert got == {3: texts[3], 100: b"", 107: texts[107]}  # 100 is a revisit


def test_empty_table(spark):
    bundles = W.build(spark.createDataFrame([], "page_id long, url string, html string"), Scratch(spark, "t"))
    assert W.read(bundles).collect() == [] and W.index(bundles).collect() == []
