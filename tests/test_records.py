import hashlib
import os
import random

import pytest
from conftest import QUALITY_BASE, row, rows

from ledgerline.schema import RAW_COLUMNS
from ledgerline.sources import raw as R
from ledgerline.sources import records as T
from ledgerline.sources import sinks as K


@pytest.fixture
def small_splits(spark):
    """Files are cut every few hundred bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "400")
    yield
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def _values(n, seed=1):
    r = random.Random(seed)
    pieces = ["plain", "", "two\nlines", 'say ""hi""'.replace('""', '"'), "a,b", "\n\n", '"', "é\r\nü", "long " * 300, 'x"\n"y', " padded "]
    return [(str(i), r.choice(pieces) + str(i), r.choice(pieces)) for i in range(n)]


def _write(path, header, values, end="\n", last=True):
    q = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in '",\n\r') else v
    text = end.join([",".join(header), *[",".join(map(q, v)) for v in values]]) + (end if last else "")
    with open(path, "w", newline="") as f:
        f.write(text)


@pytest.mark.parametrize("end,last", [("\n", True), ("\n", False), ("\r\n", True)])
def test_one_file_in_many_splits(spark, tmp_path, small_splits, end, last):
    values, p = _values(200), str(tmp_path / "one.csv")
    _write(p, ["id", "a", "b"], values, end, last)
    df = R.read_raw_csv(spark, p, multi_line=True)
    assert T.split_lines(spark, p).rdd.getNumPartitions() > 20
    want = sorted((i, a, b or None) for i, a, b in values)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    if end == "\n":  # Spark's whole-file reader turns line ends inside values into line feeds otherwise
        assert sorted(map(tuple, R.read_raw_csv(spark, p, multi_line="whole").collect()), key=str) == sorted(want, key=str)


def test_a_record_is_parsed_once(spark, tmp_path):
    """Not once for each of its fields; and the pieces at the edges of splits are put together once, not with every read."""
    p = str(tmp_path / "one.csv")
    _write(p, ["id", "a", "b"], _values(20))
    plan = R.read_raw_csv(spark, p, multi_line=True)._jdf.queryExecution().optimizedPlan().toString()
    parses = [line for line in plan.splitlines() if "from_csv(" in line and '"h' not in line and "inline" in line.lower()]
    assert parses and all(line.count("from_csv(StructField(id") <= 1 for line in parses)
    assert plan.count("MapInArrow") == 1


def test_many_files_and_faults(spark, tmp_path, small_splits):
    for k in range(5):
        _write(str(tmp_path / f"f{k}.csv"), ["id", "a"], [(f"{k}-{i}", v) for i, v, _ in _values(30, k)])
    got = [r["id"] for r in R.read_raw_csv(spark, str(tmp_path), multi_line=True).collect()]
    assert sorted(got) == sorted(f"{k}-{i}" for k in range(5) for i in range(30))
    _write(str(tmp_path / "f9.csv"), ["id", "other"], [("x", "y")])
    with pytest.raises(Exception, match="another header"):
        R.read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    long_ = str(tmp_path / "long.csv")
    _write(long_, ["id", "a"], [("1", "x", "too many")])
    with pytest.raises(Exception, match="More than 2 fields"):
        R.read_raw_csv(spark, long_, multi_line=True).collect()
    with open(tmp_path / "odd.csv", "w") as f:
        f.write('id,a\n1,"never closed\n2,x\n')
    with pytest.raises(Exception, match="quoted value"):
        R.read_raw_csv(spark, str(tmp_path / "odd.csv"), multi_line=True).collect()
    with pytest.raises(ValueError):
        R.read_raw_csv(spark, long_, multi_line="other")


def test_header_alone_and_short_rows(spark, tmp_path):
    _write(str(tmp_path / "h.csv"), RAW_COLUMNS, [])
    assert R.read_raw_csv(spark, str(tmp_path / "h.csv"), multi_line=True).count() == 0
    _write(str(tmp_path / "s.csv"), ["id", "a", "b"], [("1", "x")])
    assert [tuple(r) for r in R.read_raw_csv(spark, str(tmp_path / "s.csv"), multi_line=True).collect()] == [("1", "x", None)]


def test_metadata_by_path(spark, tmp_path):
    """A name with a blank, and two files of one name in two folders."""
    base = row(QUALITY_BASE)
    for folder, name, n in (("a", "x.csv", 3), ("b", "x.csv", 5), ("b", "my sales.csv", 2)):
        os.makedirs(tmp_path / folder, exist_ok=True)
        _write(str(tmp_path / folder / name), RAW_COLUMNS, [[v or "" for v in base]] * n)
    got = {(r["path"].split("/")[-2], r["filename"]): r for r in R.ingest_metadata(spark, str(tmp_path / "*")).collect()}
    assert {k: v["row_count"] for k, v in got.items()} == {("a", "x.csv"): 3, ("b", "x.csv"): 5, ("b", "my sales.csv"): 2}
    for (folder, name), r in got.items():
        assert r["sha256"] == hashlib.sha256((tmp_path / folder / name).read_bytes()).hexdigest() and r["digest_kind"] == "sha256"


def test_tree_digest_of_large_files(spark, tmp_path, monkeypatch, small_splits):
    monkeypatch.setattr(R, "WHOLE_FILE", 0)
    monkeypatch.setattr(T, "LEAVES", 8)
    values = _values(60)
    sha = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()

    def brute(p):
        data = open(p, "rb").read()
        leaf = [sha(x) for x in data.removesuffix(b"\n").split(b"\n")]
        nodes = [sha("".join(leaf[i: i + 8])) for i in range(0, len(leaf), 8)]
        return sha(sha("".join(nodes)) + f":{len(data)}")

    seen = set()
    for k, rows_ in enumerate((values, values[::-1], values[:-1])):
        p = str(tmp_path / f"d{k}.csv")
        _write(p, ["id", "a", "b"], rows_)
        r = R.ingest_metadata(spark, p, multi_line=True).first()
        assert r["digest_kind"] == "sha256-lines" and r["sha256"] == brute(p) and r["row_count"] == len(rows_)
        seen.add(r["sha256"])
    assert len(seen) == 3  # another order is another digest


def test_exported_files_read_back(spark, tmp_path):
    df = rows(spark, row(QUALITY_BASE, product_name='5" pipe\nsecond, line'), row(QUALITY_BASE, order_id="O2", region=None))
    path = K.export_csv(df, str(tmp_path / "e.csv"))
    assert sorted(map(str, R.read_raw_csv(spark, path, multi_line=True).collect())) == sorted(map(str, df.collect()))
