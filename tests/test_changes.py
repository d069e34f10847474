"""Landing files that change under a name that is known."""

from __future__ import annotations

import pytest
from test_recovery import CANCELLED, GOOD, NEXT, state, write_file

from tillroll.operators import bronze as layers
from tillroll.plans import changes, pipeline
from tillroll.plans.pipeline import Layout

FIRST, SECOND = "sales_2010_12.csv", "sales_2011_01.csv"


@pytest.fixture
def layout(spark, workdir):
    layout = Layout(f"{workdir}/p")
    write_file(f"{layout.landing}/{FIRST}", [GOOD, CANCELLED])
    write_file(f"{layout.landing}/{SECOND}", [NEXT])
    pipeline.run_increment(spark, layout)
    return layout


def reported(spark, layout, **options):
    return sorted(map(tuple, changes.changed_files(spark, layout, **options).collect()))


def test_only_other_content_is_reported(spark, layout):
    assert reported(spark, layout) == []
    write_file(f"{layout.landing}/{FIRST}", [CANCELLED, GOOD])  # the same lines in another order
    assert reported(spark, layout) == []
    write_file(f"{layout.landing}/{FIRST}", [GOOD, GOOD])
    write_file(f"{layout.landing}/{SECOND}", [])
    write_file(f"{layout.landing}/sales_2011_02.csv", [GOOD])  # new, not changed
    want = [(FIRST, 2, 2), (SECOND, 0, 1)]
    assert reported(spark, layout) == want == reported(spark, layout, max_names=1)
    before = state(spark, layout)
    assert reported(spark, layout) == want and state(spark, layout) == before  # reading changes nothing


def test_a_file_that_is_older_than_its_record_is_not_read(spark, layout):
    write_file(f"{layout.landing}/{FIRST}", [NEXT], 86_400 * 40)
    assert reported(spark, layout) == []
    assert reported(spark, layout, slack="60 days") == [(FIRST, 1, 2)]


def test_a_changed_file_is_taken_again(spark, layout, workdir):
    whole = Layout(f"{workdir}/whole")
    for where in (layout, whole):
        write_file(f"{where.landing}/{FIRST}", [NEXT, GOOD, GOOD])
        write_file(f"{where.landing}/{SECOND}", [CANCELLED])  # nothing of it is kept any more
    pipeline.run_increment(spark, layout)  # knows the names, takes nothing
    assert changes.reload_changed(spark, layout) == [FIRST, SECOND]
    pipeline.run_increment(spark, whole)
    assert state(spark, layout)[:2] == state(spark, whole)[:2]  # rows and gold
    assert changes.reload_changed(spark, layout) == [] == reported(spark, layout)
    assert pipeline.run_increment(spark, layout)["bronze"]["files"] == 0


def test_a_reload_that_breaks_off_is_done_again(spark, layout, workdir, monkeypatch):
    whole = Layout(f"{workdir}/whole")
    for where in (layout, whole):
        write_file(f"{where.landing}/{FIRST}", [GOOD, NEXT])
        write_file(f"{where.landing}/{SECOND}", [NEXT])
    pipeline.run_increment(spark, whole)
    for broken in ("write_partials", "build_gold"):
        with monkeypatch.context() as m:
            m.setattr(pipeline, broken, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                changes.reload_changed(spark, layout)
        assert reported(spark, layout) == [(FIRST, 2, 2)]
    with monkeypatch.context() as m:
        write = layers.write_layer
        m.setattr(layers, "write_layer", lambda df, path: 1 / 0 if path == layout.bronze else write(df, path))
        with pytest.raises(ZeroDivisionError):
            changes.reload_changed(spark, layout)
    assert changes.reload_changed(spark, layout) == [FIRST]
    assert state(spark, layout)[:2] == state(spark, whole)[:2]  # rows and gold
