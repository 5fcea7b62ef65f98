"""All tables of a publish appear at one instant; of two writers one wins."""

from __future__ import annotations

import os
import threading

import pytest

from pricecube.operators import quality, versions
from pricecube.operators.publish import QualityGateError


def frames(spark, n):
    return {"a": spark.range(n).selectExpr("id", f"{n} as n"), "b": spark.range(2 * n).selectExpr("id as k", f"{n} as n")}


def seen(snapshot):
    """(n, rows) of each table in one query."""
    a, b = snapshot.table("a"), snapshot.table("b")
    rows = a.selectExpr("'a' as t", "n").unionAll(b.selectExpr("'b' as t", "n")).groupBy("t", "n").count().collect()
    return sorted(map(tuple, rows))


def test_a_reader_between_two_switches_never_sees_a_mix(spark, tmp_dir):
    assert versions.latest(spark, tmp_dir) == 0
    with pytest.raises(ValueError):
        versions.Snapshot(spark, tmp_dir)
    assert versions.publish(spark, tmp_dir, frames(spark, 3)) == 1
    before = versions.Snapshot(spark, tmp_dir)
    lazy = before.tables()
    staged = versions.stage(spark, tmp_dir, frames(spark, 5))
    while_written = versions.Snapshot(spark, tmp_dir)
    assert seen(before) == seen(while_written) == [("a", 3, 3), ("b", 3, 6)]
    assert versions.commit(spark, staged) == 2
    assert seen(versions.Snapshot(spark, tmp_dir)) == [("a", 5, 5), ("b", 5, 10)]
    # Readers made before the switch stay with their version, also those made table by table.
    assert seen(before) == seen(while_written) == [("a", 3, 3), ("b", 3, 6)]
    assert (lazy["a"].count(), lazy["b"].count(), before.table("b").count()) == (3, 6, 6)
    assert seen(versions.Snapshot(spark, tmp_dir, 1)) == [("a", 3, 3), ("b", 3, 6)]


def test_only_the_version_is_read(spark, tmp_dir):
    for n in (1, 2, 3):
        versions.publish(spark, tmp_dir, frames(spark, n))
    table = versions.Snapshot(spark, tmp_dir).table("a")
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and "Subquery" in plan
    scans = [s for s in table.selectExpr("input_file_name() as f").distinct().collect()]
    assert len({s.f.split("version=")[1][:32] for s in scans}) == 1


def test_one_winner(spark, tmp_dir):
    first, second = (versions.stage(spark, tmp_dir, {"t": spark.range(n)}) for n in (3, 4))
    assert versions.commit(spark, first, 1) == 1
    with pytest.raises(versions.LostRaceError):
        versions.commit(spark, second, 1)
    versions.discard(spark, second)
    versions.discard(spark, first)  # a committed one stays
    assert versions.Snapshot(spark, tmp_dir).table("t").count() == 3
    assert len(os.listdir(f"{tmp_dir}/t")) == 1 and len([f for f in os.listdir(f"{tmp_dir}/_versions") if f.endswith(".json")]) == 1
    assert versions.commit(spark, versions.stage(spark, tmp_dir, {"t": spark.range(9)})) == 2


def test_loaders_at_the_same_time(spark, tmp_dir):
    ready, won = threading.Barrier(3), {}

    def load(n):
        ready.wait()
        won[n] = versions.load_first(spark, tmp_dir, "raw", spark.range(n), as_of="2025-01-01 00:00:00")

    loaders = [threading.Thread(target=load, args=(n,)) for n in (10, 20, 30)]
    [t.start() for t in loaders]
    [t.join() for t in loaders]
    winners = [n for n, (mine, _) in won.items() if mine]
    assert len(winners) == 1 and {t.count() for _, t in won.values()} == set(winners)
    again, table = versions.load_first(spark, tmp_dir, "raw", spark.range(1))
    assert not again and table.count() == winners[0] and table.columns == ["id", "loaded_at"]


def test_a_failing_rule_changes_nothing(spark, tmp_dir):
    versions.publish(spark, tmp_dir, frames(spark, 3))
    bad = frames(spark, 5) | {"b": spark.sql("select cast(null as int) as k, 5 as n")}
    with pytest.raises(QualityGateError, match="b.k not_null=1"):
        versions.publish(spark, tmp_dir, bad, {"a": [quality.not_null("id")], "b": [quality.not_null("k")]})
    assert seen(versions.Snapshot(spark, tmp_dir)) == [("a", 3, 3), ("b", 3, 6)]
    assert len(os.listdir(f"{tmp_dir}/a")) == len(os.listdir(f"{tmp_dir}/b")) == 1


def test_other_columns_in_a_later_version_and_vacuum(spark, tmp_dir):
    for n in (1, 2, 3):
        versions.publish(spark, tmp_dir, {"t": spark.range(n).selectExpr(f"id as x{n}", "cast(0.5 as decimal(10,4)) as p")})
    assert versions.Snapshot(spark, tmp_dir, 1).table("t").columns == ["x1", "p"]
    now = versions.Snapshot(spark, tmp_dir).table("t")
    assert now.columns == ["x3", "p"] and now.count() == 3
    assert versions.vacuum(spark, tmp_dir, keep=1) == [1, 2]
    assert now.count() == 3 and versions.Snapshot(spark, tmp_dir).number == 3
    with pytest.raises(ValueError):
        versions.Snapshot(spark, tmp_dir, 1)
    with pytest.raises(ValueError):
        versions.publish(spark, tmp_dir, {"t": spark.range(1).selectExpr("id as Version")})
