"""The keyed refresh: newest by arrival, whatever the names, batches and checkpoints."""

import os
import time

import pytest
from pyspark.sql import functions as F

from parlance import schemas
from parlance.session import new_folder
from parlance.sources import writers
from parlance.streaming import current as cu, refresh as rf
from tests.test_files import _report


def dump(spark, landing, name, users, label):
    """One file with a row per user; its name is given, so that names can disagree with arrivals."""
    folder = new_folder(spark, "dump")
    writers.write_csv(_report(spark, users).withColumn("nombre", F.lit(label)).coalesce(1), folder)
    source = next(f for f in os.listdir(folder) if f.startswith("part-"))
    os.makedirs(landing, exist_ok=True)
    with open(f"{folder}/{source}", "rb") as file, open(f"{landing}/{name}.csv", "wb") as out:
        out.write(file.read())
    time.sleep(0.02)


def names(df):
    return {r["usuario_id"]: r["nombre"] for r in df.collect()}


@pytest.fixture
def folders(spark):
    return [new_folder(spark, n).removeprefix("file:") for n in ("landing", "state", "progress")]


def test_newest_dump_of_a_batch_wins_by_arrival(spark, folders):
    landing, state, progress = folders
    dump(spark, landing, "part-00000-f0", ["u1", "u2"], "old")
    dump(spark, landing, "part-00000-a0", ["u1"], "new")
    cu.refresh_current(spark, landing, state, progress, buckets=4)
    assert names(cu.read_current(spark, state)) == {"u1": "new", "u2": "old"}
    target = new_folder(spark, "target")
    rf.refresh(spark, landing, target, new_folder(spark, "progress"))
    assert names(rf.latest_per_user(rf.read_refreshed(spark, target))) == {"u1": "new", "u2": "old"}


def test_third_batch_restart_and_lost_checkpoint(spark, folders):
    landing, state, progress = folders
    for number, (users, label) in enumerate([(["u1", "u2", "u3"], "a"), (["u2"], "b"), (["u3", "u4"], "c")]):
        dump(spark, landing, f"z{9 - number}", users, label)
        cu.refresh_current(spark, landing, state, progress, buckets=4)
    newest = {"u1": "a", "u2": "b", "u3": "c", "u4": "c"}
    assert names(cu.read_current(spark, state)) == newest
    cu.refresh_current(spark, landing, state, progress)  # nothing new
    assert names(cu.read_current(spark, state)) == newest
    # A lost checkpoint reads all files again, in one batch or one by one.
    for files in (None, 1):
        cu.refresh_current(spark, landing, state, new_folder(spark, "progress"), max_files=files)
        assert names(cu.read_current(spark, state)) == newest
    assert cu.read_current(spark, state).columns == schemas.TYPED_REPORT.names


def test_a_batch_rewrites_its_own_buckets_only(spark, folders):
    landing, state, progress = folders
    dump(spark, landing, "a", [f"u{i}" for i in range(40)], "old")
    cu.refresh_current(spark, landing, state, progress, buckets=8)
    before = cu.bucket_list(spark, state)
    dump(spark, landing, "b", ["u1"], "new")
    cu.refresh_current(spark, landing, state, progress, buckets=3)  # the state keeps its 8 buckets
    after = cu.bucket_list(spark, state)
    assert len(before) == 8 and set(after) == set(before)
    assert sum(after[b] != before[b] for b in after) == 1
    assert sum(v == "old" for v in names(cu.read_current(spark, state)).values()) == 39


def test_a_batch_that_runs_again_starts_from_the_list_before_it(spark, folders):
    landing, state, progress = folders
    dump(spark, landing, "a", ["u1", "u2"], "old")
    cu.refresh_current(spark, landing, state, progress, buckets=4)
    batch = _report(spark, ["u2"]).withColumn("nombre", F.lit("new")).select(
        *[F.col(c).cast("string") for c in schemas.USER_REPORT.names], F.lit("f").alias(rf.FILE_COLUMN),
        F.current_timestamp().alias(rf.ARRIVAL_COLUMN))
    write = cu.merge_batch(state)
    write(batch, 5)
    write(batch, 5)
    assert names(cu.read_current(spark, state)) == {"u1": "old", "u2": "new"}
    assert cu.read_current(spark, state).count() == 2


def test_rows_without_user_and_an_empty_state(spark, folders):
    landing, state, progress = folders
    assert cu.read_current(spark, state).collect() == []
    row = _report(spark, ["u1"]).withColumn("usuario_id", F.lit(None).cast("string")).select(
        *[F.col(c).cast("string") for c in schemas.USER_REPORT.names], F.lit("f").alias(rf.FILE_COLUMN),
        F.current_timestamp().alias(rf.ARRIVAL_COLUMN))
    write = cu.merge_batch(state)
    write(row, 0)
    write(row.limit(0), 1)
    write(row.withColumn("nombre", F.lit("later")), 2)
    assert names(cu.read_current(spark, state)) == {None: "later"}
