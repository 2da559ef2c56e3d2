from __future__ import annotations

from datetime import date, datetime
from unittest.mock import MagicMock

import duckdb
import pytest
from pyspark.sql import functions as F

from forecourt.operators.schema import TableSpec
from forecourt.sources import databases
from forecourt.sources.extracts import export_csv, find_extracts, read_extract, read_extract_set
from forecourt.sources.zones import land, read_image, read_zone, snapshot, write_zone
from tests.conftest import rows

SPEC = TableSpec({"Libellé": "label", "volume": "volume"}, {"extra": "double"})


def deliver(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode("iso-8859-1"))


def test_extract_is_text_in_latin_1(spark, tmp_path):
    deliver(tmp_path, "a.csv", "Libellé;volume ;unused\nhélène;0012;x\n;;\n")
    out = read_extract(spark, str(tmp_path / "a.csv"), SPEC)
    assert out.dtypes == [("label", "string"), ("volume", "string"), ("extra", "double")]
    assert rows(out) == [("hélène", "0012", None), (None, None, None)]


def test_multiline_extract(spark, tmp_path):
    text = 'My label;vol\r ume;x\'y\r\n"two\nlines";1;"a"\r\n"stray\rreturn";2;b\rc\r\n'
    deliver(tmp_path, "m.csv", text)
    out = read_extract(spark, str(tmp_path / "m.csv"), multiline=True)
    assert out.columns == ["My_label", "vol_ume", "x_y"]
    assert rows(out) == [("strayreturn", "2", "bc"), ("two\nlines", "1", "a")]


def test_extract_set_by_prefix_and_header(spark, tmp_path):
    folder = tmp_path / "in"
    deliver(folder, "offers_FR_1.csv", "Libellé;volume\na;1\n")
    deliver(folder, "offers_FR_2.csv", "Libellé;volume\nb;2\n")
    deliver(folder, "offers_FR_3.csv", "volume;more;Libellé\n3;x;c\n")
    deliver(folder, "offers_SP_1.csv", "Libellé;volume\nd;4\n")
    assert len(find_extracts(spark, str(folder), "offers_FR")) == 3
    spec = TableSpec({"Libellé": "label", "volume": "volume", "country": "country"})
    out = read_extract_set(spark, str(folder), "offers_FR", "FR", spec)
    assert rows(out) == [("a", "1", "FR"), ("b", "2", "FR"), ("c", "3", "FR")]
    traced = TableSpec({"volume": "volume", "file": "file"})
    shown = read_extract_set(spark, str(folder), "offers_FR", spec=traced, file_column="file")
    assert rows(shown) == [(str(i), f"offers_FR_{i}.csv") for i in (1, 2, 3)]
    with pytest.raises(FileNotFoundError):
        read_extract_set(spark, str(folder), "offers_XX")


def test_export_csv(spark, frame, tmp_path):
    export_csv(frame([("a", 1)], "x string, n int"), str(tmp_path / "out"))
    assert rows(spark.read.csv(str(tmp_path / "out"), header=True)) == [("a", "1")]


def test_overwrite_replaces_what_it_covers(spark, frame, tmp_path):
    path, kind = str(tmp_path / "zone"), "v int, country string, brand string"
    write_zone(frame([(1, "F", "A"), (2, "F", "B"), (3, "G", "A")], kind), path, ("country", "brand"))
    write_zone(frame([(4, "F", "C"), (5, "H", "A")], kind), path, ("country", "brand"), only=[{"country": "F"}])
    assert rows(read_zone(spark, path), "v", "country", "brand") == [(3, "G", "A"), (4, "F", "C")]
    write_zone(frame([(6, "H", "A"), (7, "H", "B")], kind), path, ("country", "brand"), only=[{"brand": "A"}])
    assert rows(read_zone(spark, path), "v", "country", "brand") == [(4, "F", "C"), (6, "H", "A")]
    write_zone(frame([], kind), path, ("country", "brand"), only=[{"country": "H", "brand": "A"}])
    assert rows(read_zone(spark, path), "v", "country", "brand") == [(4, "F", "C")]
    write_zone(frame([], kind), path, ("country", "brand"))
    assert rows(read_zone(spark, path)) == []
    write_zone(frame([(9, "F", "A")], kind), path, ("country", "brand"), sort_within=("v",))
    assert rows(read_zone(spark, path), "v", "country", "brand") == [(9, "F", "A")]
    write_zone(frame([(8, "F", "A")], kind), path, ("country", "brand"), mode="append")
    assert rows(read_zone(spark, path, "F", "A"), "v", "country", "brand") == [(8, "F", "A"), (9, "F", "A")]
    plan = read_zone(spark, path, brand="B")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(brand" in plan


def test_hot_partition_is_written_by_many_tasks(spark, settings, tmp_path):
    settings(adaptive__advisoryPartitionSizeInBytes="64KB", shuffle__partitions=4)
    hot = spark.range(200_000, numPartitions=8).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("F").alias("country"))
    write_zone(hot, str(tmp_path / "zone"), ("country",))
    assert len(list((tmp_path / "zone" / "country=F").glob("*.parquet"))) > 4


def files_in(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_land_copies_what_changed(spark, frame, tmp_path):
    src, raw = tmp_path / "src", tmp_path / "raw"
    tables = {"a": ("country",), "b": ()}
    write_zone(frame([(1, "F")], "v int, country string"), str(src / "a"), ("country",))
    write_zone(frame([(2,)], "v int"), str(src / "b"))
    assert land(spark, tables, str(src), str(raw)) == ["a", "b"]
    before = files_in(raw)
    assert land(spark, tables, str(src), str(raw)) == [] and files_in(raw) == before
    write_zone(frame([(3,)], "v int"), str(src / "b"))
    assert land(spark, tables, str(src), str(raw)) == ["b"]
    assert rows(read_zone(spark, str(raw / "b"))) == [(3,)]
    write_zone(frame([(9, "F")], "v int, country string"), str(raw / "a"), ("country",))  # someone changed the copy
    assert land(spark, tables, str(src), str(raw)) == ["a"]
    assert rows(read_zone(spark, str(raw / "a"), "F")) == [(1, "F")]


def test_a_second_image_copies_what_changed(spark, frame, tmp_path):
    raw, images = str(tmp_path / "raw"), tmp_path / "hist"
    tables, kind = {"a": ("year", "month"), "b": (), "c": ()}, "v int, year int, month int"
    write_zone(frame([(1, 2020, 1), (2, 2020, 2), (3, 2021, 1)], kind), f"{raw}/a", ("year", "month"))
    write_zone(frame([(5,)], "v int"), f"{raw}/b")
    write_zone(frame([], "v int"), f"{raw}/c")
    first = snapshot(spark, tables, raw, str(images), datetime(2020, 1, 2, 3, 4, 5))
    assert first.endswith("image_as_of=2020-01-02_03-04-05")
    assert rows(spark.read.parquet(f"{first}/a")) == rows(read_image(spark, first, "a")) == [(1, 2020, 1), (2, 2020, 2), (3, 2021, 1)]
    write_zone(frame([(7, 2020, 2)], kind), f"{raw}/a", ("year", "month"), only=[{"year": 2020, "month": 2}, {"year": 2021, "month": 1}])
    second = snapshot(spark, tables, raw, str(images), datetime(2020, 2, 1))
    copied = {p.rpartition("/")[0] for p in files_in(images) if p.startswith("image_as_of=2020-02")}
    assert copied == {"image_as_of=2020-02-01_00-00-00/a/year=2020/month=2"}
    assert rows(read_image(spark, second, "a")) == [(1, 2020, 1), (7, 2020, 2)]
    assert rows(read_image(spark, second, "b")) == [(5,)] and read_image(spark, second, "c").columns == ["v"]
    third = snapshot(spark, tables, raw, str(images), datetime(2020, 3, 1))
    assert rows(read_image(spark, third, "a")) == [(1, 2020, 1), (7, 2020, 2)]
    assert rows(read_image(spark, first, "a"))[1] == (2, 2020, 2)  # older images stay what they were
    with pytest.raises(FileNotFoundError):
        read_image(spark, str(images / "image_as_of=1999-01-01_00-00-00"), "a")


class Recorder:
    """Stands in for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        def tell(*args, **kwargs):
            if name == "option":
                self.told[args[0]] = args[1]
            elif name == "options":
                self.told.update(kwargs)
            else:
                self.told[name] = args[0] if args else True
            return self

        return tell


def test_publication_options():
    df, writer = MagicMock(), Recorder()
    df.write = writer
    databases.publish_jdbc(df, "jdbc:x", "t", {"a": 3, "b": 1}, properties={"driver": "D"})
    told = writer.told
    assert (told["url"], told["dbtable"], told["mode"], told["truncate"], told["driver"]) == ("jdbc:x", "t", "overwrite", "true", "D")
    assert told["createTableColumnTypes"] == "`a` VARCHAR(3), `b` VARCHAR(1)"
    assert told["save"] is True


def test_measured_widths(frame, monkeypatch):
    real, writer = frame([("abc", 1)], "a string, n int"), Recorder()
    df = MagicMock(wraps=real)
    df.dtypes, df.agg, df.write = real.dtypes, real.agg, writer
    databases.publish_jdbc(df, "jdbc:x", "t", widths=True)
    assert writer.told["createTableColumnTypes"] == "`a` VARCHAR(3)"


def test_database_read_options():
    spark, reader = MagicMock(), Recorder()
    spark.read = reader
    databases.read_jdbc(spark, "jdbc:x", "(select 1) q", properties={"driver": "D"})
    told = reader.told
    assert (told["url"], told["dbtable"], told["fetchsize"], told["driver"]) == ("jdbc:x", "(select 1) q", "10000", "D")
    assert "numPartitions" not in told


class Answers:
    """Stands in for a session that reads from a database; DuckDB within this process runs the SQL."""

    def __init__(self, con):
        self.con, self.asked = con, []

    read = property(lambda self: self)

    def format(self, _):
        return self

    def options(self, **_):
        return self

    def option(self, name, value):
        if name == "dbtable":
            self.asked.append(value)
        return self

    def load(self):
        found = self.con.execute(f"select * from {self.asked[-1]}").fetchall()
        return MagicMock(collect=lambda: found)

    def jdbc(self, url, table, predicates, properties):
        """How many rows each task would read."""
        return [self.con.execute(f"select count(*) from {table} where {p}").fetchone()[0] for p in predicates]


@pytest.mark.parametrize("column", ["id", "day", "name", "moment"])
def test_database_read_in_equal_shares(column):
    """Ids with a long tail: ranges of equal width would give one task nearly everything."""
    con = duckdb.connect()
    con.execute(
        """create table sold as select n, case when n % 50 <> 7 then n * n * n end as id,
        date '2020-01-01' + cast(sqrt(n) as integer) as day, chr(39) || n as name,
        timestamp '2020-01-01' + to_seconds(n * n) as moment from range(4000) t(n)"""
    )
    shares = databases.read_jdbc(Answers(con), "jdbc:x", "sold", split=(column, 8))
    assert sum(shares) == 4000 and len(shares) == 8 and max(shares) < 4000 / 8 * 1.3


def test_database_read_with_a_hot_value_or_none():
    con = duckdb.connect()
    con.execute("create table hot as select case when n % 3 = 0 then 5 else n end as id from range(900) t(n)")
    shares = databases.read_jdbc(Answers(con), "jdbc:x", "(select * from hot)", split=("id", 10))
    assert sum(shares) == 900 and max(shares) < 420
    con.execute("create table nothing as select 1 as id where false")
    assert databases.read_jdbc(Answers(con), "jdbc:x", "nothing", split=("id", 4)) == [0]
    con.execute("create table missing as select cast(null as integer) as id from range(5)")
    assert databases.read_jdbc(Answers(con), "jdbc:x", "missing", split=("id", 4)) == [5]
