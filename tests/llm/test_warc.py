import base64
import gzip
import hashlib
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import warc


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, "http://a/3", None), (4, None, ""), (5, "http://a/5", "é" * 5000),
         (6, "http://a/ 6\r\nX: y", "WARC/1.1\r\n\r\n0\r\n\r\n" * 40), (7, "http://a/7", "q" * 100_000), (None, "http://a/8", "same"),
         (None, "http://a/9", "only null"), (2, "http://a/2", "same"), (7, "http://a/7b", "another text of page 7")]


def expected(pages):
    last = {}
    for i, _, h in pages:
        b = (h or "").encode()
        last[b] = max([x for x in (last.get(b), i) if x is not None], default=None)
    out = []
    for i, _, h in pages:
        b = (h or "").encode()
        rev = last[b] is not None and (i is None or i < last[b])
        out.append((str(i), len(b), digest(b), "revisit" if rev else "response", str(last[b]) if rev else "None"))
    return sorted(out)


def got(rows):
    name = lambda x: "None" if x is None else x.split(":")[2].rstrip(">").replace("null", "None")
    return sorted((name(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, name(r.refers_to)) for r in rows)


def test_round_trip(spark):
    df = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, digest string, n int")
    for size in (300, 7000, 1 << 20):
        path = tempfile.mkdtemp() + "/a"
        warc.write_archives(df, path, segment_bytes=size, file_records=3)
        rows = warc.read_records(spark, path).collect()
        assert got(rows) == expected(PAGES) and all(r.status == "ok" for r in rows)
        for r in rows:
            if r.record_type == "response":
                assert digest(bytes(r.payload)) == r.payload_digest == r.stated_digest.removeprefix("sha1:")
        assert max(r.n_segments for r in rows) == (1 if size == 1 << 20 else max(r.n_segments for r in rows))
        assert got(warc.read_records(spark, path, payloads=False).collect()) == expected(PAGES)


def test_empty_input(spark):
    path = tempfile.mkdtemp() + "/a"
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_records(spark, path).count() == 0


def segments(spark, parts):
    own = ("<o>", "response", "u", None, None) + (None,) * 5
    rows = [(own if n == 1 else ("<c>", "continuation") + (None,) * 8, ("<o>", n, total, block)) for n, total, block in parts]
    return warc.reassemble(spark.createDataFrame(
        rows, f"record struct<{warc._struct(warc.RECORD)}>, part struct<origin:string,number:int,total:bigint,block:binary>"))


def test_faults_are_told(spark):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"hello world, hello again", 7)
    a, b, c = block[:30], block[30:60], block[60:]
    status = lambda parts: segments(spark, parts).first().status
    ok = segments(spark, [(3, len(block), c), (1, None, a), (2, None, b)]).first()
    assert ok.status == "ok" and bytes(ok.payload) == b"hello world, hello again" and ok.n_segments == 3
    assert status([(1, None, a), (3, len(block), c)]) == "missing segment"
    assert status([(1, None, a), (2, None, b)]) == "missing segment"
    assert status([(1, None, a), (2, None, b), (2, None, b), (3, len(block), c)]) == "repeated segment"
    assert status([(1, None, a), (2, None, b), (3, len(block) + 1, c)]) == "wrong length"
    assert status([(1, None, a), (2, len(block) - len(c) - 1, b[:-1])]) == "broken framing"


def test_reads_plain_members_and_foreign_records():
    info = warc.record([("WARC-Type", "warcinfo")], b"x")
    one = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<1>")], b"HTTP/1.1 200 OK\r\n\r\nplain\r\n\r\nbody")
    for data in (info + one, gzip.compress(info) + gzip.compress(one)):
        (_, _), (h, block) = list(warc.Records(data))
        p = warc.Payload()
        assert h["warc-type"] == "response" and p.feed(block) == b"plain\r\n\r\nbody" and p.ended()


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50), st.integers(1, 40))
def test_chunked_framing_in_any_pieces(body, chunk, piece):
    data = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(body, chunk)
    p = warc.Payload()
    assert b"".join(p.feed(data[i: i + piece]) for i in range(0, len(data), piece)) == body and p.ended()


def test_cut_records_and_segments_of_other_types(spark, tmp_path):
    head = b"HTTP/1.1 200 OK\r\n\r\n"
    whole = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<1>")], head + b"body")
    cut = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<2>")], head + b"another body")[:-9]
    (tmp_path / "a.warc").write_bytes(whole + cut)
    (tmp_path / "b.warc").write_bytes(whole.replace(b"<1>", b"<3>") + b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Rec")
    part = lambda kind, n, block, more=(): warc.record([("WARC-Type", kind), ("WARC-Record-ID", f"<s{n}>"), *more,
                                                         ("WARC-Segment-Number", str(n))], block)
    (tmp_path / "c.warc").write_bytes(part("resource", 1, b"first half, ") + part("continuation", 2, b"second", [
        ("WARC-Segment-Origin-ID", "<s1>"), ("WARC-Segment-Total-Length", "18")]) + warc.record([("WARC-Type", "metadata"), ("WARC-Record-ID", "<m>")], b"x"))
    got = {r.record_id: r for r in warc.read_records(spark, str(tmp_path / "*.warc")).collect()}
    assert set(got) == {"<1>", "<2>", "<3>", None, "<s1>"}
    assert got["<1>"].status == got["<3>"].status == "ok" and got["<2>"].status == got[None].status == "wrong length"
    assert got["<s1>"].status == "ok" and got["<s1>"].record_type == "resource" and bytes(got["<s1>"].payload) == b"first half, second"
