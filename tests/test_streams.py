"""Streams over hand-made files: what comes late, twice or in the wrong order."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import streams as s

T0 = datetime(2024, 1, 1)
SCHEMA = "user string, ts timestamp_ntz, id long, opens boolean, extra string"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, table, check):
    stream = s.read_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, per_trigger=1)
    s.stream_marker_groups(stream, table, ["user"], ["ts", "id"], F.col("opens"), F.date_trunc("hour", "ts"), F.to_date("ts"), check)
    return s.marker_groups(spark, table, ["user"], "no")


def plainly(rows):
    out, seen = [], {}
    for user, ts, i, opens, _ in sorted(set(rows), key=lambda r: (r[1], r[2])):
        seen[user] = seen.get(user, -1) + bool(opens)
        out.append((i, None if seen[user] < 0 else seen[user]))
    return sorted(out)


def files(table, day):
    at = f"{table}/rows/marker_by={day}"
    return sorted(x for x in os.listdir(at) if x.startswith("part"))


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / x) for x in ("landing", "table", "check")]


def test_markers_in_any_order_of_arrival(spark, places):
    """One user holds a third of the rows; a null user and null flags; every order of files gives the batch result."""
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "b", "c", None, "d"]), T0 + timedelta(minutes=rng.randrange(4 * 1440)), i, rng.choice([True, False, False, None]), "x") for i in range(600)]
    rng.shuffle(rows)
    folder, table, check = places
    for i in range(0, 600, 150):
        land(spark, folder, rows[i:i + 150] + rows[:20])
    out = run(spark, folder, table, check)
    assert out.columns == ["user", "ts", "id", "opens", "extra", "no"]
    assert sorted((r.id, r.no) for r in out.collect()) == plainly(rows)


def test_a_late_marker_rewrites_its_own_day_only(spark, places):
    folder, table, check = places
    rows = [("u", T0 + timedelta(days=d, hours=h), d * 10 + h, h == 1, None) for d in range(3) for h in range(4)]
    land(spark, folder, rows)
    assert sorted((r.id, r.no) for r in run(spark, folder, table, check).collect()) == plainly(rows)
    before = {d: files(table, f"2024-01-0{d}") for d in (1, 2, 3)}
    late = ("u", T0 + timedelta(hours=2, minutes=30), 99, True, None)
    land(spark, folder, [late])
    out = run(spark, folder, table, check)
    assert sorted((r.id, r.no) for r in out.collect()) == plainly([*rows, late])
    assert files(table, "2024-01-01") != before[1] and [files(table, f"2024-01-0{d}") for d in (2, 3)] == [before[2], before[3]]


def test_a_retried_batch_and_rows_without_time(spark, places):
    """The same files under a new checkpoint, as if the last commit had been lost: nothing counts twice."""
    folder, table, check = places
    rows = [("u", T0, 1, True, None), ("u", None, 2, True, None), ("u", T0 + timedelta(days=1), 3, True, None)]
    land(spark, folder, rows)
    run(spark, folder, table, check)
    out = run(spark, folder, table, check + "2")
    assert sorted((r.id, r.no) for r in out.collect()) == [(1, 1), (2, 0), (3, 2)]
