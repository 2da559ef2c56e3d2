"""Replacing tables and partitions under failures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forecourt.sources import commits
from forecourt.sources.files import Files, content_of
from forecourt.sources.zones import read_zone, write_zone
from tests.conftest import rows

KIND, BY = "v int, country string, brand string", ("country", "brand")
OLD = [(1, "F", "A"), (2, "F", "B"), (3, "G", "A")]


def hidden(folder):
    return sorted(p.name for p in folder.iterdir() if p.name.startswith(".") and not p.name.endswith(".crc"))


def values(spark, path):
    return rows(read_zone(spark, path), "v", "country", "brand")


@pytest.mark.parametrize("only", [(), [{"country": "F"}], [{"brand": "A"}]])
def test_a_failed_write_keeps_the_old_rows(spark, frame, tmp_path, only):
    path = str(tmp_path / "zone")
    write_zone(frame(OLD, KIND), path, BY)
    broken = frame([(k, "F" if k % 2 else "G", "A") for k in range(100)], KIND).repartition(8, "v")
    v = F.when(F.col("v") == 77, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.col("v"))
    with pytest.raises(Exception, match="broken row"):
        write_zone(broken.withColumn("v", v), path, BY, only=only)
    assert values(spark, path) == OLD
    assert hidden(tmp_path) == []


def cut_off(monkeypatch, after: int):
    """Let so many moves and removals happen, and fail from then on."""
    left = [after]

    def failing(method):
        def call(self, *args):
            if left[0] == 0:
                raise ConnectionError("driver lost")
            left[0] -= 1
            return method(self, *args)

        return call

    for name in ("move", "remove"):
        monkeypatch.setattr(Files, name, failing(getattr(Files, name)))


NEW = [(7, "F", "B"), (8, "F", "C"), (9, "G", "A")]


@pytest.mark.parametrize("only,after", [((), NEW), ([{"country": "F"}], [(3, "G", "A"), (7, "F", "B"), (8, "F", "C")]), ([{"brand": "A"}, {"country": "G", "brand": "Z"}], [(2, "F", "B"), (9, "G", "A")])])
def test_a_switch_that_is_cut_off_is_finished(spark, frame, tmp_path, monkeypatch, only, after):
    outcomes = set()
    done = False
    for steps in range(15):
        path = str(tmp_path / f"zone{steps}")
        write_zone(frame(OLD, KIND), path, BY)
        with monkeypatch.context() as patch:
            cut_off(patch, steps)
            try:
                write_zone(frame(NEW, KIND), path, BY, only=only)
                done = True
            except ConnectionError:
                pass
        commits.recover(spark, path)
        assert hidden(tmp_path) == []
        found = values(spark, path)
        assert found in (OLD, after)
        outcomes.add((done, found == after))
        if done:
            break
    assert (True, True) in outcomes and (False, True) in outcomes and (True, False) not in outcomes
    assert not commits.recover(spark, path)


def test_rows_without_a_journal_are_thrown_away(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "zone")
    write_zone(frame(OLD, KIND), path, BY)
    with monkeypatch.context() as patch:
        patch.setattr(Files, "write", lambda *_: (_ for _ in ()).throw(ConnectionError("driver lost")))
        with pytest.raises(ConnectionError):
            write_zone(frame(NEW, KIND), path, BY)
    assert values(spark, path) == OLD and any(".staged-" in name for name in hidden(tmp_path))
    assert not commits.recover(spark, path)
    assert values(spark, path) == OLD and hidden(tmp_path) == []


def test_the_next_write_recovers_by_itself(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "zone")
    write_zone(frame(OLD, KIND), path, BY)
    with monkeypatch.context() as patch:
        cut_off(patch, 2)
        with pytest.raises(ConnectionError):
            write_zone(frame([(5, "F", "Q")], KIND), path, BY, only=[{"country": "F"}])
    write_zone(frame([(6, "H", "A")], KIND), path, BY, only=[{"country": "H"}])
    assert values(spark, path) == [(3, "G", "A"), (5, "F", "Q"), (6, "H", "A")]


def test_empty_partitions_vanish_and_empty_tables_keep_their_columns(spark, frame, tmp_path):
    path = str(tmp_path / "zone")
    write_zone(frame(OLD, KIND), path, BY)
    write_zone(frame([], KIND), path, BY, only=[{"brand": "A"}])
    assert values(spark, path) == [(2, "F", "B")]
    assert not list((tmp_path / "zone").glob("*/brand=A"))
    write_zone(frame([], KIND), path, BY, only=[{"country": "F"}])
    assert read_zone(spark, path).columns == ["v", "country", "brand"] and values(spark, path) == []
    write_zone(frame(NEW, KIND), path, BY, only=[{"country": "F"}])
    assert values(spark, path) == NEW[:2]
    numbered = str(tmp_path / "numbered")
    write_zone(frame([], "v int, period int"), numbered, ("period",))
    assert read_zone(spark, numbered).dtypes == [("v", "int"), ("period", "int")]


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, frame, tmp_path):
    path = str(tmp_path / "zone")
    write_zone(frame(OLD, KIND), path, BY)
    write_zone(read_zone(spark, path).withColumn("v", F.col("v") + 10), path, BY, only=[{"country": "F"}])
    assert values(spark, path) == [(11, "F", "A"), (12, "F", "B"), (3, "G", "A")]


def test_cached_rows_are_read_anew(spark, frame, tmp_path):
    path = str(tmp_path / "zone")
    write_zone(frame(OLD, KIND), path, BY)
    kept = read_zone(spark, path).cache()
    assert kept.count() == 3
    write_zone(kept.unionAll(kept.withColumn("brand", F.lit("Z"))), path, BY)
    assert read_zone(spark, path).count() == 6
    kept.unpersist()


def test_odd_partition_values(spark, frame, tmp_path):
    path = str(tmp_path / "zone")
    odd = [(1, "a/b", "50%"), (2, "a b", "x=y"), (3, "é", "A")]
    write_zone(frame(odd, KIND), path, BY)
    write_zone(frame([(4, "a/b", "50%")], KIND), path, BY, only=[{"country": "a/b"}])
    write_zone(frame([(5, "a b", "x=y")], KIND), path, BY, only=[{"brand": "x=y"}])
    assert values(spark, path) == [(3, "é", "A"), (4, "a/b", "50%"), (5, "a b", "x=y")]


def test_small_files_and_contents(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    assert files.read("a.json") is None
    files.write("a.json", {"x": 1})
    files.write("a.json", {"x": "é"})
    assert files.read("a.json") == {"x": "é"} and hidden(tmp_path) == []
    folder = tmp_path / "data"
    assert content_of(spark, str(folder)) == ""
    (folder / "sub").mkdir(parents=True)
    (folder / "sub" / "one").write_text("1")
    first = content_of(spark, str(folder))
    assert first == content_of(spark, str(folder)) != ""
    (folder / "two").write_text("1")
    assert content_of(spark, str(folder)) != first
