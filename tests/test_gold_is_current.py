"""Gold holds every file of silver after an increment, whatever went before."""

from __future__ import annotations

import pytest
from test_recovery import GOOD, NEXT, state, write_file

from tillroll.operators import gold
from tillroll.plans import pipeline
from tillroll.plans.pipeline import Layout


@pytest.fixture
def both(spark, workdir):
    """A pipeline whose gold has one of two files, and what it shall be."""
    layout, whole = Layout(f"{workdir}/p"), Layout(f"{workdir}/whole")
    write_file(f"{layout.landing}/sales_2010_12.csv", [GOOD])
    pipeline.run_increment(spark, layout)
    write_file(f"{layout.landing}/sales_2011_01.csv", [NEXT])
    for name, lines in (("sales_2010_12.csv", [GOOD]), ("sales_2011_01.csv", [NEXT])):
        write_file(f"{whole.landing}/{name}", lines)
    pipeline.run_increment(spark, whole)
    return layout, state(spark, whole)


def test_a_crash_between_silver_and_gold(spark, both, monkeypatch):
    layout, want = both
    with monkeypatch.context() as m:
        m.setattr(pipeline, "build_gold", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run_increment(spark, layout)
    assert pipeline.run_increment(spark, layout)["silver"]["files"] == 0
    assert state(spark, layout) == want


def test_steps_run_by_themselves(spark, both):
    layout, want = both
    pipeline.ingest_bronze(spark, layout)
    pipeline.transform_silver(spark, layout)
    pipeline.run_increment(spark, layout)
    assert state(spark, layout) == want


def test_a_crash_within_gold(spark, both, monkeypatch):
    """Some tables are of the new build, others of the one before."""
    layout, want = both
    tables = gold.gold_tables

    def first_only(saved, k):
        yield from list(tables(saved, k).items())[:1]
        raise ZeroDivisionError

    class Broken:
        def __init__(self, *args):
            self.items = lambda: first_only(*args)

    with monkeypatch.context() as m:
        m.setattr(gold, "gold_tables", Broken)
        with pytest.raises(ZeroDivisionError):
            pipeline.run_increment(spark, layout)
    pipeline.run_increment(spark, layout)
    assert state(spark, layout) == want
    with monkeypatch.context() as m:  # also a build that adds no file
        m.setattr(gold, "gold_tables", Broken)
        with pytest.raises(ZeroDivisionError):
            pipeline.build_gold(spark, layout, k=1)
    pipeline.run_increment(spark, layout)
    assert state(spark, layout) == want
