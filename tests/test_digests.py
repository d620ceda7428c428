"""Digests of whole files from their lines."""

import gzip
import hashlib

from ledgerline.sources import raw as R


def test_digests_are_of_the_bytes(spark, tmp_path):
    """Line ends, marks and packed files give the same digests."""
    body = "order_id,a\n" + "".join(f"{i},é{i}\r\n" for i in range(30000))
    texts = {"plain.csv": body.encode(), "open.csv": body.rstrip("\r\n").encode(), "mark.csv": b"\xef\xbb\xbf" + body.encode(),
             "mark open.csv": b"\xef\xbb\xbforder_id,a\n1,2", "bad.csv": b"order_id,a\n\xff\xfe,\x80\n\n\n",
             "one.csv": b"order_id,a", "p.csv.gz": gzip.compress(body.encode())}
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    got = {r["filename"]: r for r in R.ingest_metadata(spark, str(tmp_path)).collect()}
    assert {n: r["sha256"] for n, r in got.items()} == {n: hashlib.sha256(b).hexdigest() for n, b in texts.items()}
    assert {r["digest_kind"] for r in got.values()} == {"sha256"}


def test_lines_of_a_file_stay_in_one_task(spark, tmp_path):
    """Small splits of the session do not cut the files that are digested."""
    for k in range(3):
        (tmp_path / f"f{k}.csv").write_text("a,b\n" + f"{k},x\n" * 5000)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "400")
    try:
        got = {r["filename"]: r["sha256"] for r in R.ingest_metadata(spark, str(tmp_path)).collect()}
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "400"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in tmp_path.glob("*.csv")}


def test_no_row_holds_a_file(spark, tmp_path):
    """A file beyond what the binary reader may take in one row still has the digest of its bytes."""
    f = tmp_path / "f.csv"
    f.write_text("a,b\n" + "1,2\n" * 1000)
    key = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(key, "1000")
    try:
        assert R.ingest_metadata(spark, str(f)).first()["sha256"] == hashlib.sha256(f.read_bytes()).hexdigest()
    finally:
        spark.conf.unset(key)
