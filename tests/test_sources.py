import datetime as dt
import gzip
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillflow.sources import JdbcSplit, dated_paths, from_values, jdbc_options, read_dated_lines, read_lines, read_log, read_zip_lines
from rillflow.sources import archive
from rillflow.sources.dated import present_days


def values(df):
    return sorted(r.value for r in df.collect())


def test_from_values(spark):
    assert [tuple(r) for r in from_values(spark, ["a", "b"], "word string").collect()] == [("a",), ("b",)]
    assert [tuple(r) for r in from_values(spark, [("k", 1)], "k string, v int").collect()] == [("k", 1)]
    assert bytes(from_values(spark, [b"0"], "data binary").first().data) == b"0"


def test_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("x\ny\r\nz\rlast é".encode())
    assert values(read_lines(spark, str(tmp_path / "a.txt"))) == ["last é", "x", "y", "z"]


def test_several_paths_and_gzip(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n2\n")
    with gzip.open(tmp_path / "b.txt.gz", "wt") as file:
        file.write("3\n")
    assert values(read_lines(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt.gz")])) == ["1", "2", "3"]


def test_zip_members(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "CHUNK_BYTES", 5)
    with zipfile.ZipFile(tmp_path / "a b.ZIP", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.csv", "alpha\r\nbeta\rgamma\n\nlong line without end")
        z.writestr("folder/", "")
        z.writestr("folder/two.csv", "δέλτα\n")
        z.writestr("empty.csv", "")
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("x", b"bad \xff byte\nok")
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    (tmp_path / "other.txt").write_text("not an archive")
    want = ["", "alpha", "beta", "gamma", "long line without end", "δέλτα", "bad � byte", "ok"]
    assert values(read_zip_lines(spark, str(tmp_path))) == sorted(want)


def test_rarer_methods_and_spoilt_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_BZIP2) as z:
        z.writestr("x", "one\ntwo")
    assert values(read_zip_lines(spark, str(tmp_path))) == ["one", "two"]
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("x", "plain text")
    data = (tmp_path / "c.zip").read_bytes().replace(b"plain text", b"plain tex!")
    (tmp_path / "c.zip").write_bytes(data)
    with pytest.raises(Exception, match="check sum"):
        read_zip_lines(spark, str(tmp_path / "c.zip")).collect()


def test_many_members_take_one_directory(tmp_path, monkeypatch):
    """The directory of an archive is parsed once, by the listing, however many members it has."""
    path = str(tmp_path / "many.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(4000):
            z.writestr(f"{i}.txt", f"line {i}\n")
    opened = []
    real = archive._open_archive
    monkeypatch.setattr(archive, "_open_archive", lambda p: opened.append(p) or real(p))
    listed = archive._list_members([pa.RecordBatch.from_pydict({"path": [path]})])
    lines = [v for batch in archive._read_members(listed) for v in batch.column(0).to_pylist()]
    assert sorted(lines) == sorted(f"line {i}" for i in range(4000)) and len(opened) == 1


def test_folder_of_archives_and_plain_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x", "one\ntwo")
    (tmp_path / "b.csv").write_text("three\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as file:
        file.write("four\n")
    assert values(read_dated_lines(spark, "", explicit=str(tmp_path))) == ["four", "one", "three", "two"]


def test_lines_of_chunks_cut_anywhere():
    rng = random.Random(5)
    for _ in range(500):
        data = bytes(rng.choice(b"ab\r\n") for _ in range(rng.randint(0, 30)))
        chunks, rest = [], data
        while rest:
            n = rng.randint(1, 6)
            chunks.append(rest[:n])
            rest = rest[n:]
        lines = [line for block in archive.line_blocks(iter(chunks)) for line in archive.block_lines(block).to_pylist()]
        assert lines == [line.decode() for line in data.splitlines()]


def test_zip_and_text_agree(spark, tmp_path):
    text = "".join(f"row {i} {'x' * (i % 50)}\n" for i in range(20_000))
    (tmp_path / "t.txt").write_text(text)
    with zipfile.ZipFile(tmp_path / "t.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for part in range(4):
            lines = text.splitlines(keepends=True)[part::4]
            z.writestr(f"p{part}", "".join(lines))
    assert values(read_zip_lines(spark, str(tmp_path / "t.zip"))) == values(read_lines(spark, str(tmp_path / "t.txt")))


@pytest.mark.parametrize("range_bytes", [1, 2, 3, 7, 50, 100_000])
def test_stored_members_are_cut_at_line_ends(tmp_path, monkeypatch, range_bytes):
    """Every line belongs to exactly one range, for all ways to end lines and places to cut."""
    monkeypatch.setattr(archive, "CHUNK_BYTES", 4)
    pick = random.Random(range_bytes)
    for _ in range(40 if range_bytes < 1000 else 5):
        content = "".join(pick.choice(["a", "é", "bcd", "\n", "\r", "\r\n", "\n\n", "\r\r\n"]) for _ in range(pick.randint(0, 60))).encode()
        with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
            z.writestr("m", content)
        want = archive.block_lines(content).to_pylist() if content else []
        with zipfile.ZipFile(tmp_path / "s.zip") as z, open(tmp_path / "s.zip", "rb") as file:
            member, got = z.infolist()[0], []
            for low, high in archive._ranges(member, range_bytes):
                for block in archive.line_blocks(archive._stored_chunks(file, member.header_offset, len(content), low, high)):
                    got += archive.block_lines(block).to_pylist()
        assert got == want, content


def test_one_stored_member_is_read_by_many_tasks(spark, tmp_path):
    lines = [f"line {i} {'x' * (i % 50)}" for i in range(5000)]
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("small", "alone\n")
        z.writestr("large", "\n".join(lines))
    read = read_zip_lines(spark, str(tmp_path), tasks=16, range_bytes=10_000)
    assert values(read) == sorted([*lines, "alone"])
    tasks = read.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 5
    # Deflated members can't be cut.
    with zipfile.ZipFile(tmp_path / "s.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("large", "\n".join(lines))
    assert read_zip_lines(spark, str(tmp_path), tasks=16, range_bytes=1000).select(F.spark_partition_id().alias("task")).distinct().count() == 1


def test_dated_paths():
    day = dt.date(2024, 2, 28)
    assert dated_paths("b/", ".csv", day) == ["b/20240228.csv"]
    assert dated_paths("b/", "", day, dt.date(2024, 3, 1)) == ["b/20240228", "b/20240229", "b/20240301"]
    assert dated_paths("b/", ".csv", day, explicit="given.csv") == ["given.csv"]
    assert dated_paths("b/") == [f"b/{dt.date.today():%Y%m%d}"]
    with pytest.raises(ValueError):
        dated_paths("b/", "", day, dt.date(2024, 1, 1))


def test_missing_days(spark, tmp_path):
    base = f"{tmp_path}/log-"
    for day in ("20240227", "20240229", "20240302", "20249999"):
        (tmp_path / f"log-{day}.txt").write_text(f"{day}\n")
    days = {"start": dt.date(2024, 2, 26), "end": dt.date(2024, 3, 1)}
    assert list(present_days(spark, base, ".txt")) == [dt.date(2024, 2, 27), dt.date(2024, 2, 29), dt.date(2024, 3, 2)]
    assert values(read_dated_lines(spark, base, ".txt", missing="skip", **days)) == ["20240227", "20240229"]
    assert values(read_dated_lines(spark, base, ".txt", dt.date(2023, 1, 1), missing="skip")) == []
    with pytest.raises(FileNotFoundError, match="2024-02-26, 2024-02-28, 2024-03-01"):
        read_dated_lines(spark, base, ".txt", **days)
    with pytest.raises(ValueError, match="missing"):
        read_dated_lines(spark, base, ".txt", missing="ignore")


def test_dated_lines(spark, tmp_path):
    for day in (1, 2, 3):
        (tmp_path / f"2024010{day}.txt").write_text(f"day {day}\n")
        with zipfile.ZipFile(tmp_path / f"2024010{day}.export.CSV.zip", "w") as z:
            z.writestr("data", f"zipped {day}\n")
    base, first, last = f"{tmp_path}/", dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    assert values(read_dated_lines(spark, base, ".txt", first, last)) == ["day 2", "day 3"]
    assert values(read_dated_lines(spark, base, ".export.CSV.zip", first, last)) == ["zipped 2", "zipped 3"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_dated_lines(spark, base, ".txt", dt.date(2023, 1, 1)).collect()


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "select 1", "d.Driver", properties={"user": "u"})
    assert plain == {"url": "jdbc:x", "query": "select 1", "driver": "d.Driver", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "select * from t", split=JdbcSplit("id", 0, 100, 4))
    assert split["dbtable"] == "(select * from t) q" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "4")


def test_log_start_time_needs_a_zone(spark):
    with pytest.raises(ValueError):
        read_log(spark, {}, start=dt.datetime(2024, 1, 1))
