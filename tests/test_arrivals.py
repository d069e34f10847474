"""What arrives in parts is worked out once, however many parts or splits read it."""

from __future__ import annotations

import pytest

from tillroll.plans import catalog
from tillroll.schemas import SOURCE_FILE
from tillroll.sources import landing, storage

SF = "/root/testdata/sf0.001"


@pytest.fixture
def joins(monkeypatch):
    """How often the sales lines were put together from their tables, and how."""
    calls = []

    def counted(spark, sf_dir, **options):
        calls.append(options)
        return whole(spark, sf_dir, **options)

    whole = catalog.sales_lines
    monkeypatch.setattr(catalog, "sales_lines", counted)
    return calls


@pytest.mark.parametrize("key", ["increment_edge_cases", "changed_files", "monthly_split"])
def test_lines_are_joined_once(spark, joins, key):
    catalog.QUERIES[key](spark, SF)
    assert len(joins) == 1


def test_both_arrivals_come_from_one_join(spark, joins):
    layout = catalog.arrival_scenario(spark, SF, "second_landed")
    assert len(joins) == 1
    here = landing.read_csv(spark, landing.landing_glob(layout.landing)).drop("_corrupt")
    want = catalog.sales_lines(spark, SF).select(*here.columns)
    assert here.exceptAll(want).isEmpty() and want.exceptAll(here).isEmpty()


def test_only_named_entries_arrive(spark, workdir):
    lines = catalog.sales_lines(spark, SF)
    outbox = catalog._outbox(spark, lines)
    names = catalog._entries(spark, outbox)
    assert names == sorted(r[0] for r in lines.select(SOURCE_FILE).distinct().collect())
    layout = catalog.Layout(workdir)
    catalog._arrive(spark, outbox, layout, [])
    assert catalog._entries(spark, layout.landing) == []
    catalog._arrive(spark, outbox, layout, names[3:5])
    assert catalog._entries(spark, layout.landing) == names[3:5]
    assert catalog._entries(spark, outbox) == names[:3] + names[5:]


def test_a_missing_entry_is_an_error(spark, workdir):
    storage.make_folder(spark, workdir)
    with pytest.raises(OSError):
        storage.move(spark, f"{workdir}/none", f"{workdir}/there")
