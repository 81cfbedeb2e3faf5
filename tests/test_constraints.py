import time
from datetime import datetime

import pytest

from starloom import workspace
from starloom.operators import constraints
from starloom.operators.constraints import ConstraintError
from starloom.plans import dimensions, star
from starloom.schemas import CUSTOMERS, DIM_CUSTOMERS, DIM_TIME, FACT_ORDERS, SOURCES, TARGETS

NOW = datetime(2020, 1, 2, 3, 4, 5)


@pytest.fixture
def write(spark, texts):
    def load(*rows):
        folder = workspace.scratch(spark, "test")
        rows = dimensions.customers(texts(CUSTOMERS.columns, *rows))
        count = star.write_table(spark, DIM_CUSTOMERS, rows, folder, NOW)
        table = star.read_table(spark, folder, DIM_CUSTOMERS)
        constraints.enforce_keys({DIM_CUSTOMERS.table: table}, (DIM_CUSTOMERS,))
        return count, table

    return load


def test_good_rows(write):
    count, table = write(("c2", "u2", "01234", " x ", " sp "), ("c1", "u1", None, None, None))
    assert count == 2
    assert sorted(map(tuple, table.collect())) == [
        (1, "c1", "u1", None, None, None, NOW),
        (2, "c2", "u2", "01234", "X", "SP", NOW),
    ]


def test_load_time_is_kept_in_any_zone_of_the_driver(write, monkeypatch):
    monkeypatch.setenv("TZ", "America/Sao_Paulo")
    time.tzset()
    try:
        _, table = write(("c1", "u1", None, None, None))
        assert table.selectExpr("string(created_at)").first()[0] == str(NOW)
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()


def test_no_rows(write):
    count, table = write()
    assert (count, table.count()) == (0, 0)


def test_too_long_state(write):
    with pytest.raises(ConstraintError, match=r"max_length\(state\): 1 violations"):
        write(("c1", "u1", None, None, "spx"))


def test_repeated_key(write):
    with pytest.raises(ConstraintError, match=r"unique\(customer_id\): 1 violations"):
        write(*[("c1", "u1", None, None, None)] * 3)


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    found = constraints.orphan_rows(child, "k", parent, "k").first()
    assert tuple(found) == (3, 2)
    none = constraints.orphan_rows(parent, "k", parent, "k").first()
    assert tuple(none) == (0, 0)


def test_not_null_rules():
    assert FACT_ORDERS.not_null == ("order_id", "order_item_id")
    assert len(DIM_TIME.not_null) == 10


def test_discard_takes_only_intermediate_folders(spark, tmp_path):
    with pytest.raises(ValueError):
        workspace.discard(spark, str(tmp_path))


def test_repeated_dimension_key_fails_the_star(spark, texts, tmp_path):
    staged = {s.table: texts(s.columns) for s in SOURCES}
    staged[CUSTOMERS.table] = texts(CUSTOMERS.columns, *[("c1", "u1", None, None, None)] * 2)
    with pytest.raises(ConstraintError, match=r"dim_customers unique\(customer_id\): 1 violations"):
        star.write_star(spark, staged, str(tmp_path))


def test_clear_removes_what_was_written(spark, write):
    from pathlib import Path

    write(("c1", "u1", None, None, None))
    workspace.clear(spark)
    assert not (Path(workspace.shared_folder(spark)) / "starloom" / spark.sparkContext.applicationId).exists()


def test_broken_keys_are_found(spark):
    customers = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "customer_key long, customer_id string")
    with pytest.raises(ConstraintError, match=r"dim_customers primary_key\(customer_key\): 2 violations"):
        constraints.enforce_keys({DIM_CUSTOMERS.table: customers}, (DIM_CUSTOMERS,))


def test_every_rule_in_one_scan_and_one_shuffle(spark, tmp_path):
    tables = {}
    for target in TARGETS:
        spark.createDataFrame([], target.schema).write.parquet(f"{tmp_path}/{target.table}")
        tables[target.table] = star.read_table(spark, str(tmp_path), target)
    report = constraints.constraint_report(tables, TARGETS)
    assert {r.bad_rows for r in report.collect()} == {0}
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("FileScan") == len(TARGETS)
    assert plan.count("Exchange hashpartitioning(rule") == 1 and "Join" not in plan
