"""Readers and runs at the same time: whole versions of gold, each line once."""

from __future__ import annotations

import json
import os
import threading

import pytest
from test_recovery import GOOD, NEXT, files_under, state, write_file

from tillroll.operators import gold, versions
from tillroll.operators.claims import claimed
from tillroll.plans import pipeline
from tillroll.plans.pipeline import Layout
from tillroll.schemas import GOLD_DDL
from tillroll.sources import storage


def values(tables):
    return sorted(map(tuple, gold.long_form(tables).collect()))


@pytest.fixture
def built(spark, workdir):
    """A pipeline with one file in gold and another waiting."""
    layout = Layout(f"{workdir}/p")
    write_file(f"{layout.landing}/sales_2010_12.csv", [GOOD])
    pipeline.run_increment(spark, layout)
    write_file(f"{layout.landing}/sales_2011_01.csv", [NEXT])
    return layout


def test_a_reader_in_the_middle_of_a_build_sees_one_version(spark, built, monkeypatch):
    before, seen = values(pipeline.read_gold(spark, built)), []
    opened = pipeline.read_gold(spark, built)  # resolved before the build, read after it
    tables = gold.gold_tables

    class Watched:
        """Gold tables that are read by somebody after each one is written."""

        def __init__(self, *args):
            self.found = tables(*args)

        def items(self):
            for item in self.found.items():
                yield item
                seen.append(values(pipeline.read_gold(spark, built)))

    with monkeypatch.context() as m:
        m.setattr(gold, "gold_tables", Watched)
        pipeline.run_increment(spark, built)
    assert len(seen) == 4 and all(s == before for s in seen)
    after = values(pipeline.read_gold(spark, built))
    assert after != before and values(opened) == before


def test_an_older_state_never_replaces_a_newer_one(spark, built):
    """Two builds: the one that read the ledger first publishes last."""
    stale = versions.current(spark, built.gold)
    pipeline.run_increment(spark, built)
    newest = versions.current(spark, built.gold)
    assert newest.source[0] == 2
    for _ in range(3):
        versions.publish(spark, built.gold, stale.tables, stale.source, versions.current(spark, built.gold))
    assert versions.current(spark, built.gold) == newest


def test_one_table_is_published_beside_the_others(spark, built):
    before = values(pipeline.read_gold(spark, built))
    source = versions.current(spark, built.gold).source
    empty = spark.createDataFrame([], GOLD_DDL["weekly_revenue"])
    pipeline.publish_gold_table(spark, built, "weekly_revenue", empty)
    after = values(pipeline.read_gold(spark, built))
    assert after == [v for v in before if v[0] != "weekly_revenue"]
    assert versions.current(spark, built.gold).source == source


def test_old_versions_go(spark, built):
    for k in (1, 2, 3, 4):
        pipeline.build_gold(spark, built, k=k)
    folders = storage.listed(spark, f"{built.gold}/versions")
    assert len(folders) == 5  # young ones stay
    assert versions.retire(spark, built.gold, keep=1, grace_s=-60) == 3
    assert len(storage.listed(spark, f"{built.gold}/versions")) == 2
    assert values(pipeline.read_gold(spark, built)) and versions.retire(spark, built.gold, keep=1, grace_s=-60) == 0


def test_a_broken_build_leaves_no_version(spark, built, monkeypatch):
    before = versions.current(spark, built.gold)
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run_increment(spark, built)
    assert versions.current(spark, built.gold) == before
    pipeline.run_increment(spark, built)
    assert versions.current(spark, built.gold).source[0] == 2


def test_catalog_tables_follow_the_version_and_the_schema(spark, built):
    try:
        pipeline.publish_tables(spark, built, "versions_test")
        name = "`versions_test`.`gold_weekly_revenue`"
        assert spark.table(name).count() == 1
        pipeline.run_increment(spark, built)
        pipeline.publish_tables(spark, built, "versions_test")
        assert spark.table(name).count() == 2
        # Another schema under the same name, as an earlier release may have left it.
        where = versions.current(spark, built.gold).tables["weekly_revenue"]
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} (WeekStartDate DATE) USING parquet LOCATION '{where}'")
        pipeline.publish_tables(spark, built, "versions_test")
        assert [f"{f.name} {f.dataType.simpleString()}" for f in spark.table(name).schema] == ["WeekStartDate date", "WeeklyRevenue double"]
        assert spark.table(name).count() == 2
        assert spark.table("`versions_test`.`silver_processed_files`").count() == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS versions_test CASCADE")


def together(*jobs):
    """Run jobs at the same time; their results, or the first error."""
    out, errors = [None] * len(jobs), []

    def run(i, job):
        try:
            out[i] = job()
        except BaseException as err:  # noqa: BLE001
            errors.append(err)

    threads = [threading.Thread(target=run, args=(i, job)) for i, job in enumerate(jobs)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return out


def test_two_increments_at_once_take_each_line_once(spark, workdir):
    both, one = Layout(f"{workdir}/both"), Layout(f"{workdir}/one")
    for layout in (both, one):
        for m in range(1, 7):
            write_file(f"{layout.landing}/sales_2011_{m:02d}.csv", [GOOD, NEXT])
    pipeline.run_increment(spark, one)
    done = together(*[lambda: pipeline.run_increment(spark, both)] * 2)
    pipeline.run_increment(spark, both)  # whichever ended first may not have seen all
    assert state(spark, both) == state(spark, one)
    assert sum(d["bronze"]["files"] for d in done) == sum(d["silver"]["files"] for d in done) == 6
    assert sum(d["bronze"]["rows"] for d in done) == 12
    assert not [f for f in files_under(f"{both.base}/claims") if not os.path.basename(f).startswith(".")]


def test_claims(spark, workdir):
    folder = f"{workdir}/claims"
    with claimed(spark, folder, ["a", "b"], run="2") as first:
        assert first == ["a", "b"]
        # A greater id leaves what another holds; what is free it takes.
        with claimed(spark, folder, ["b", "c"], run="3") as second:
            assert second == ["c"]
    with claimed(spark, folder, ["b"], run="3") as free:
        assert free == ["b"]
    # A run that died is passed over once its claim is old, and its claim goes.
    storage.put(spark, f"{folder}/1", json.dumps(["x"]))
    with claimed(spark, folder, ["x"], run="3") as held:
        assert held == []
    with claimed(spark, folder, ["x"], expiry_s=-60, run="3") as late:
        assert late == ["x"] and "1" not in storage.listed(spark, folder)


def test_the_smaller_id_waits_for_one_that_was_first(spark, workdir):
    folder, order = f"{workdir}/claims", []
    started = threading.Event()

    def later():
        started.wait()
        with claimed(spark, folder, ["a"], run="1") as own:
            order.append(("1", own))

    def earlier():
        with claimed(spark, folder, ["a"], run="2") as own:
            started.set()
            threading.Event().wait(2)
            order.append(("2", own))

    together(later, earlier)
    assert order == [("2", ["a"]), ("1", ["a"])]


def test_a_claim_that_breaks_off_is_given_back(spark, workdir):
    with pytest.raises(ZeroDivisionError), claimed(spark, f"{workdir}/c", ["a"]):
        1 / 0  # noqa: B018
    assert storage.listed(spark, f"{workdir}/c") == {}
