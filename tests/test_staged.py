"""Ranges of days that are seen whole or not at all."""

import glob

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.schemas import SUMMARY_SCHEMA
from tidemark.sources import IncompleteError, read_summary, staged, write_days
from tidemark.sources.staged import read_order, settle, stage_days


def summary(spark, value, *days):
    """One row for each day of January 2024; None is undated."""
    empty = (None,) * 2
    found = [(None, 0.0, float(value), *empty, *((2024, "01", f"{d:02d}") if d else (None,) * 3)) for d in days]
    return spark.createDataFrame(found, SUMMARY_SCHEMA)


def held(spark, table):
    return sorted((repr(r["day"]), r["max_demand_mw"]) for r in read_summary(spark, table).collect())


def expected(value, *days):
    return sorted((repr(f"{d:02d}" if d else None), float(value)) for d in days)


def always(day):
    return True


@pytest.fixture
def table(spark, folder):
    write_days(summary(spark, 1, 4, 5, 6, 7), folder)
    return folder


def left(table):
    return [f for f in glob.glob(f"{table.removeprefix('file:')}/_*") if "_SUCCESS" not in f]


def test_a_range_is_replaced_and_nothing_is_left_behind(spark, table):
    write_days(summary(spark, 2, 5, 8, None), table, stands_for=lambda day: day.day >= 5)
    assert held(spark, table) == sorted(expected(2, 5, 8, None) + expected(1, 4))
    assert rows(spark.read.schema(SUMMARY_SCHEMA).parquet(table)) == rows(read_summary(spark, table))
    assert not left(table) and not settle(spark, table)


def test_a_writer_that_fails_before_the_order_changes_nothing(spark, table, monkeypatch):
    def fail(*args):
        raise OSError("gone")

    monkeypatch.setattr(staged, "_commit", fail)
    with pytest.raises(OSError):
        write_days(summary(spark, 2, 5, 8), table, stands_for=always)
    assert held(spark, table) == expected(1, 4, 5, 6, 7)
    monkeypatch.undo()
    write_days(summary(spark, 2, 5, 8), table, stands_for=always)
    assert held(spark, table) == expected(2, 5, 8)


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
@pytest.mark.parametrize("halfway", [False, True])
def test_a_writer_that_fails_between_moves_leaves_the_new_range_to_be_seen(spark, table, monkeypatch, moves, halfway):
    """Halfway: the old day is deleted, the new one not yet in its place."""
    move, made = staged._move, []

    def some(session, folder, target):
        if len(made) == moves:
            if halfway:
                place, system = staged._place(session, target)
                system.delete(place, True)
            raise OSError("gone")
        made.append(move(session, folder, target))

    monkeypatch.setattr(staged, "_move", some)
    new = expected(2, 5, 6, 8, 9)
    with pytest.raises(OSError):
        write_days(summary(spark, 2, 5, 6, 8, 9), table, stands_for=always)
    assert held(spark, table) == new and read_order(spark, table)
    monkeypatch.undo()
    assert settle(spark, table) and not left(table)
    assert held(spark, table) == new
    assert rows(spark.read.schema(SUMMARY_SCHEMA).parquet(table)) == rows(read_summary(spark, table))


@pytest.mark.parametrize("mode", ["replace", "append", "overwrite"])
def test_whoever_writes_next_finishes_the_moves(spark, table, mode):
    stage_days(summary(spark, 2, 5), table, lambda parts: parts[2] == "06")
    assert held(spark, table) == sorted(expected(2, 5) + expected(1, 4, 7))
    write_days(summary(spark, 3, 9), table, mode)
    kept = [] if mode == "overwrite" else expected(2, 5) + expected(1, 4, 7)
    assert held(spark, table) == sorted(kept + expected(3, 9)) and not left(table)


def test_what_was_not_staged_whole_is_not_ordered(spark, table, monkeypatch):
    found = staged.day_folders
    monkeypatch.setattr(staged, "day_folders", lambda s, root: {} if "_staged" in root else found(s, root))
    with pytest.raises(IncompleteError):
        write_days(summary(spark, 2, 5), table, stands_for=always)
    monkeypatch.undo()
    assert held(spark, table) == expected(1, 4, 5, 6, 7)


def test_no_rows_and_no_table(spark, table, folder):
    write_days(summary(spark, 2), table, stands_for=lambda day: day.day == 5)
    assert held(spark, table) == expected(1, 4, 6, 7)
    write_days(summary(spark, 2, 5, None), f"{folder}/new", stands_for=always)
    assert held(spark, f"{folder}/new") == expected(2, 5, None)
    write_days(summary(spark, 2), f"{folder}/none", stands_for=always)
    assert held(spark, f"{folder}/none") == []
