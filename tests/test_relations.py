"""Filters and grouping over relationships: fixtures worked by hand, and every
slice of a grouped measure against the measure under that slice's filter."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.plans import items_measures as I
from opsgrain.plans import measures as M
from opsgrain.plans.relations import Edge, Slice
from opsgrain.sources.adapter import Tables

SMALL = "/root/testdata/sf0.001"


class Tiny:
    by = ()

    def __init__(self, spark):
        def table(rows, schema):
            return spark.createDataFrame(rows, schema)

        self.containers = table([(1, 1, "Stored"), (2, 1, None), (3, 2, "Stored"), (4, 2, "Outside"), (None, 1, "Stored")], "PrimaryKey long, TemplatePrimaryKey long, Status string")
        self.container_templates = table([(1, True), (2, True)], "PrimaryKey long, IsGoodsToPerson boolean")
        self.template_compartments = table([(1, 0, 0), (1, 1, 0), (2, 0, 0)], "TemplatePrimaryKey long, XPosition long, YPosition long")
        self.units_of_measure = table([(10, 100), (11, 100), (12, 101)], "PrimaryKey long, ProductPrimaryKey long")
        self.products = table([(100, "A"), (101, "B"), (102, "C")], "PrimaryKey long, Sku string")
        self.inventory = table([(1, 1, 10, 0, 0, 5, None), (2, 1, 11, 1, 0, 7, "Available"), (3, 2, 12, 0, 0, 2, None), (4, 3, 12, 9, 0, 4, None), (5, None, None, None, None, None, "Pending")],
                               "PrimaryKey long, ContainerPrimaryKey long, UnitOfMeasurePrimaryKey long, ContainerX long, ContainerY long, Quantity long, Status string")
        self.tasks_cyclecount = table([(50, 1), (51, 3), (52, None)], "InventoryTaskPrimaryKey long, ContainerPrimaryKey long")
        self.inventory_tasks = table([(50, 7, False), (51, 8, False), (53, 9, False)], "PrimaryKey long, TaskGroupPrimaryKey long, IsClosed boolean")

    def all(self):
        return self


def got(df: DataFrame) -> dict:
    return {tuple(r)[:-1]: tuple(r)[-1] for r in df.collect()}


def test_grouped_by_hand(spark):
    m = Tiny(spark)
    # eligible containers: 1, 2, 3 and the one without a key; compartment rows: (0,0) (1,0) (0,0)
    assert got(M.measure(M.locations_empty, m)) == {(): 4 * 3 - (3 + 2 + 0)}
    assert got(M.measure(M.locations_empty, m, ["containers.Status"])) == {("Stored",): 3 * 3 - 3, (None,): 3 - 2}
    assert got(M.measure(M.locations_empty, m, ["template_compartments.XPosition"])) == {(0,): 4 * 2 - (2 + 2), (1,): 4 - 1}
    assert got(M.measure(M.avg_units_per_bin, m, ["containers.Status"])) == {("Stored",): 8.0, (None,): 1.0}
    assert got(M.measure(M.avg_units_per_sku, m, ["products.Sku"])) == {("A",): 12.0, ("B",): 6.0, ("C",): 0.0}
    assert got(M.measure(M.avg_units_per_sku, m, ["Status"])) == {(None,): 11 / 3, ("Available",): 7 / 3}
    assert got(M.measure(M.avg_units_per_location, m, ["containers.Status"])) == {("Stored",): 12 / (2 * 2 * 1), (None,): 2 / 2, ("Outside",): 0.0}


def test_filters_over_added_and_two_way_relationships(spark):
    m = Tiny(spark)
    counted = Edge("tasks_cyclecount", "ContainerPrimaryKey", "containers", "PrimaryKey")
    groups = {"fn": M.distinct_task_groups, "m": m, "where": {"containers": "TemplatePrimaryKey = 1"}}
    assert got(M.measure(**groups)) == {(): 3}  # no path
    assert got(M.measure(**groups, treatas=[counted])) == {(): 3}  # the filter stops at the fact
    assert got(M.measure(**groups, treatas=[counted], both=[("tasks_cyclecount", "inventory_tasks")])) == {(): 1}
    back = M.measure(M.quantity, m, where={"inventory_tasks": "TaskGroupPrimaryKey = 8"}, treatas=[counted])
    assert got(back) == {(): 4}  # tasks -> counts -> containers -> inventory


def test_errors(spark):
    m = Tiny(spark)
    for fn in (M.locations_empty, M.avg_units_per_bin, M.avg_units_per_sku, M.avg_locations_per_sku, M.avg_units_per_location):
        with pytest.raises(ValueError, match="cannot group"):
            M.measure(fn, m, ["NoSuchColumn"])
    with pytest.raises(ValueError, match="no relationship"):
        Slice(m, both=[("inventory", "products")])
    with pytest.raises(ValueError, match="already connected"):
        Slice(m, treatas=[Edge("inventory", "UnitOfMeasurePrimaryKey", "products", "PrimaryKey")])


@pytest.mark.parametrize(("fn", "table", "column"), [
    (M.locations_empty, "containers", "Status"), (M.locations_empty, "template_compartments", "YPosition"), (M.avg_units_per_location, "containers", "TemplatePrimaryKey"),
    (M.avg_units_per_location, "template_compartments", "XPosition"), (M.avg_units_per_bin, "containers", "TemplatePrimaryKey"), (M.avg_units_per_sku, "products", "Sku"),
    (M.avg_locations_per_sku, "containers", "Status"), (M.older_cycle_count_open, "inventory_tasks", "TaskGroupPrimaryKey")])
def test_each_slice_equals_the_filtered_measure(spark, fn, table, column):
    m = I.model_of(Tables(spark, SMALL))
    rows = M.measure(fn, m, [f"{table}.{column}"]).collect()
    assert len(rows) > 1
    for r in rows[:4]:
        alone = M.measure(fn, m, where={table: F.col(column).eqNullSafe(F.lit(r[0]))}).first()
        assert tuple(alone) == tuple(r)[1:], r


def test_shuffled_rows_of_one_task_are_bounded(spark):
    from opsgrain.session import ADVISORY, TASK_BYTES
    from opsgrain.sources.adapter import Tables

    before = spark.conf.get(ADVISORY)
    try:
        for given, want in (("64MB", TASK_BYTES), ("1g", TASK_BYTES), ("8m", 8 << 20), (str(4 << 20), 4 << 20)):
            spark.conf.set(ADVISORY, given)
            Tables(spark, "/root/testdata/sf0.001")
            now = spark.conf.get(ADVISORY)
            assert (given if want < TASK_BYTES else str(want)) == now
    finally:
        spark.conf.set(ADVISORY, before)
