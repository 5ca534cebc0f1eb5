"""Zip archives read as rows of bytes, against the zipfile module."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from geoobs.plans import store_queries
from geoobs.sources import archives, flux_csv


def _lines(spark, path, wanted="true"):
    rows = archives.byte_rows(spark, path)
    found = archives.members(rows)
    got = archives.member_lines(rows, found.filter(wanted)).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["archive"], r["member"], r["line_no"])):
        lines = out.setdefault((r["archive"].rsplit("/", 1)[1], r["member"]), [])
        assert r["line_no"] == len(lines)
        lines.append(r["line"])
    return out


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_bytes_are_those_of_the_files(spark, tmp_path, small_splits):
    some = random.Random(1)
    files = {"a.bin": some.randbytes(40_000), "b.bin": b"", "c.bin": b"\n\n\r\n", "d.bin": b"x" * 9000,
             "e.bin": b"\xef\xbb\xbfno newline \xff\xfe", "f.bin": b"\n" + some.randbytes(7000) + b"\n"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    got = {}
    for r in archives.byte_rows(spark, str(tmp_path)).orderBy("archive", "offset").collect():
        held = got.setdefault(r["archive"].rsplit("/", 1)[1], bytearray())
        if not (r["offset"] == len(held) or r["archive"].endswith("e.bin")):
            raise AssertionError((r["archive"], r["offset"], len(held)))
        held += r["bytes"]
    for name, content in files.items():
        if name != "e.bin":  # a byte order mark at the start of a text file is not kept
            assert bytes(got.get(name, b"")) == content, name


def test_members_of_several_archives(spark, tmp_path, small_splits):
    some = random.Random(2)
    want = {}
    for a in range(3):
        with zipfile.ZipFile(tmp_path / f"z{a}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.comment = b"a comment\nof two lines"
            for m in range(6):
                lines = [f"{some.random()},é{i},{'q' * some.randrange(30)}" for i in range(some.randrange(900))]
                info = zipfile.ZipInfo(f"deep/m{m}ü.csv")
                info.compress_type = zipfile.ZIP_STORED if m == 2 else zipfile.ZIP_DEFLATED
                z.writestr(info, "\r\n".join(lines) + ("\n" if m % 2 else ""))
                if lines:
                    want[f"z{a}.zip", info.filename] = lines
            z.writestr("empty.csv", "")
            z.writestr("folder/", "")
    assert _lines(spark, str(tmp_path)) == want
    some_of = _lines(spark, str(tmp_path), "member LIKE '%m1%' OR member LIKE '%m2%'")
    assert some_of == {k: v for k, v in want.items() if "m1" in k[1] or "m2" in k[1]}


def test_unseekable_and_empty_archives(spark, tmp_path):
    class Pipe(io.RawIOBase):
        def __init__(self):
            self.data = b""

        def writable(self):
            return True

        def write(self, b):
            self.data += bytes(b)
            return len(b)

    pipe = Pipe()
    with zipfile.ZipFile(pipe, "w", zipfile.ZIP_DEFLATED) as z:  # sizes follow the data
        z.writestr("one.csv", "1\n2\n")
        z.writestr("two.csv", "3")
    (tmp_path / "p.zip").write_bytes(pipe.data)
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    assert _lines(spark, str(tmp_path)) == {("p.zip", "one.csv"): ["1", "2"], ("p.zip", "two.csv"): ["3"]}


def test_long_member_over_many_batches(spark, tmp_path, small_splits):
    lines = [f"{i},{i * i}" for i in range(120_000)]
    with zipfile.ZipFile(tmp_path / "l.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big.csv", "\n".join(lines))
    assert _lines(spark, str(tmp_path)) == {("l.zip", "big.csv"): lines}


@pytest.mark.parametrize("damage, message", [
    (lambda b: b[:-30], "no end record|damaged|zip archive"),
    (lambda b: b.replace(b"PK\x01\x02", b"PK\x09\x09"), "damaged"),
    (lambda b: b[:60] + bytes([b[60] ^ 255]) + b[61:], "damaged|invalid|incorrect"),
    (lambda b: b"no archive at all\n" * 50, "zip archive"),
])
def test_damaged_archives_fail(spark, tmp_path, damage, message):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m.csv", "".join(f"{i * 7919 % 1000}\n" for i in range(500)))
    (tmp_path / "d.zip").write_bytes(damage(out.getvalue()))
    with pytest.raises(Exception, match=message):
        _lines(spark, str(tmp_path))


def test_no_value_holds_an_archive(spark, tmp_path):
    some = random.Random(4)
    with zipfile.ZipFile(tmp_path / "r.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m.csv", "".join(f"{some.random()}\n" for _ in range(60_000)))
    rows = archives.byte_rows(spark, str(tmp_path))
    longest = rows.agg(F.max(F.octet_length("bytes"))).first()[0]
    assert longest < (tmp_path / "r.zip").stat().st_size / 50


def test_lines_are_inflated_once(spark, tmp_path):
    for a in range(2):
        with zipfile.ZipFile(tmp_path / f"z{a}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for site, name in (("A-1", "TA_F"), ("B-1", "P_F")):
                z.writestr(f"deep/ICOSETC_{site}_FLUXNET_DD_L2.csv",
                           f"TIMESTAMP,{name}\n20200101,{a}\n20200102,5\n")
            z.writestr("README.csv", "no,product\n")
    read = flux_csv.read_archives(spark, str(tmp_path / "*.zip"))
    assert sorted(columns[1] for columns, _ in read) == ["P_F", "TA_F"]
    for columns, rows in read:
        assert sorted(r[columns[1]] for r in rows.collect()) == ["0", "1", "5", "5"]
        # Rows come from stored lines: no archive is read or inflated again for them.
        assert "MapInArrow" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_one_header_is_read_from_stored_lines(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("ICOSETC_A-1_FLUXNET_DD_L2.csv", "TIMESTAMP,TA_F\n20200101,1\n")
    ((_, rows),) = flux_csv.read_archives(spark, str(tmp_path / "*.zip"))
    assert [r["TA_F"] for r in rows.collect()] == ["1"]
    # The stored lines themselves: they were not written a second time.
    assert all("archive-lines" in f for f in rows.inputFiles() if "headers" not in f)


def test_landed_archives_hold_their_lines(spark, tmp_path):
    rows = [(a, f"m{m}", i, f"{a},é{m},{i}") for a in range(2) for m in range(3) for i in range(20 * m + 1)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        store_queries._zipped(spark.createDataFrame(
            rows, "archive long, member string, ord int, value string"), str(tmp_path / "z"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for a in range(2):
        (file,) = (tmp_path / "z" / f"archive={a}").glob("*.txt")
        with zipfile.ZipFile(file) as z:
            for m in range(3):
                want = "".join(r[3] + "\n" for r in rows if r[:2] == (a, f"m{m}"))
                assert z.read(f"m{m}").decode() == want
