"""What a load leaves on disk while it runs, and tables written and checked in several runs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom import files, queries, session, workspace
from starloom.jobs import load, publish
from starloom.operators import constraints, keys, ranges
from starloom.plans import star
from starloom.schemas import CUSTOMERS, DIM_CUSTOMERS, FACT_ORDERS, ORDER_ITEMS, ORDERS, SOURCES, TARGETS

NOW = datetime(2020, 1, 2, 3, 4, 5)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Generated tables of their own: 300 orders of two lines, one of 400 lines."""
    folder = str(tmp_path_factory.mktemp("tables"))
    n, day = F.col("id"), F.timestamp_add("DAY", F.col("id").cast("int") % 40, F.lit("2020-01-01").cast("timestamp_ntz"))
    lines = spark.range(600).select((n % 300).alias("order"), n).unionAll(spark.range(400).select(F.lit(7), n))
    made = {
        "region": spark.range(2).select(n.cast("int").alias("r_regionkey"), F.concat(F.lit("R "), n).alias("r_name")),
        "nation": spark.range(4).select(
            n.cast("int").alias("n_nationkey"), (n % 2).cast("int").alias("n_regionkey"), F.concat(F.lit("N"), n).alias("n_name")
        ),
        "customer": spark.range(120).select(
            n.alias("c_custkey"), F.concat(F.lit("c"), n).alias("c_name"), (n % 4).cast("int").alias("c_nationkey")
        ),
        "part": spark.range(90).select(n.alias("p_partkey"), F.concat(F.lit("a "), n).alias("p_name"), n.alias("p_size")),
        "orders": spark.range(300).select(
            n.alias("o_orderkey"), (n % 120).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), day.alias("o_orderdate")
        ),
        "lineitem": lines.select(
            F.col("order").alias("l_orderkey"),
            (n % 90).alias("l_partkey"),
            (n % 5).alias("l_suppkey"),
            (n % 7).cast("int").alias("l_linenumber"),
            (n % 50).cast("double").alias("l_quantity"),
            (n + 0.25).alias("l_extendedprice"),
            day.alias("l_shipdate"),
        ),
    }
    for name, frame in made.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return folder


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def scratch_labels(spark):
    return {folder.rsplit("/", 1)[-1].rsplit("-", 1)[0] for folder in files.list_folders(spark, workspace._own(spark))}


def left_behind(spark, query, tables):
    """Labels of scratch folders and shuffle files that are there after a query only."""
    workspace.clear(spark)
    before = shuffle_files(spark)
    rows = queries.QUERIES[query](spark, tables)
    left = scratch_labels(spark), shuffle_files(spark) - before
    assert rows.count() > 0
    return left


def test_fact_orders_keeps_neither_shuffles_nor_lines(spark, tables):
    labels, shuffles = left_behind(spark, "fact_orders", tables)
    assert labels == {"star"} and not shuffles


def test_fact_orders_with_gaps_keeps_neither_shuffles_nor_lines(spark, tables):
    labels, shuffles = left_behind(spark, "fact_orders_with_gaps", tables)
    assert labels == {"star"} and not shuffles


def test_full_load_keeps_neither_shuffles_nor_raw_files(spark, tables):
    labels, shuffles = left_behind(spark, "full_load", tables)
    assert labels == {"mart"} and not shuffles


def test_load_row_counts_keeps_neither_shuffles_nor_raw_files(spark, tables):
    labels, shuffles = left_behind(spark, "load_row_counts", tables)
    assert labels == {"mart"} and not shuffles


def test_raw_files_are_released_once_they_are_staged(spark, tables, tmp_path):
    root, raw, seen = str(tmp_path / "mart"), str(tmp_path / "raw"), []
    with session.strict(spark):
        for table, frame in queries.samples.staging(spark, tables).items():
            queries._write_csv(frame, f"{raw}/{table}")

        def ingested():
            seen.append(publish.staging(spark, root).latest().row_counts[ORDER_ITEMS.table])
            files.delete(spark, raw)

        done = load.load(spark, root, raw, patterns={s.table: s.table for s in SOURCES}, ingested=ingested)
    assert seen == [1_000]
    assert [stage.outcome for stage in done] == ["done"] * 3
    assert done[-1].row_counts[FACT_ORDERS.table] == 1_000


def texts_of(spark, target, folder):
    rows = star.read_table(spark, folder, target)
    return sorted(str(row) for row in rows.collect())


def test_shuffles_follow_the_size_of_the_tables(spark, tables, monkeypatch):
    monkeypatch.setattr(session, "_PARTITION_BYTES", 1_000)
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    made = star.write_star
    monkeypatch.setattr(star, "write_star", lambda *a, **b: seen.append(spark.conf.get("spark.sql.shuffle.partitions")) or made(*a, **b))
    assert queries.QUERIES["fact_orders"](spark, tables).count() == 1_000
    size = sum(files.total_length(spark, f"{tables}/{name}.parquet") for name in queries.samples.TABLES)
    assert [int(n) for n in seen] == [session.partitions_for(size)] and int(seen[0]) > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_staged_rows_are_released_before_the_keys_are_checked(spark, tables, monkeypatch):
    order = []
    monkeypatch.setattr(constraints, "enforce_keys", lambda *a, **b: order.append("checked"))
    with session.strict(spark):
        staged = queries.samples.staging(spark, tables)
        star.write_star(spark, staged, workspace.scratch(spark, "star"), NOW, written=lambda: order.append("written"))
    assert order == ["written", "checked"]


def test_star_in_runs_is_the_star_in_one(spark, tables, monkeypatch):
    with session.strict(spark):
        staged = queries.samples.staging(spark, tables)
        folders = [workspace.scratch(spark, "star") for _ in range(2)]
        counts = [star.write_star(spark, staged, folders[0], NOW)]
        monkeypatch.setattr(keys, "ROWS_A_RUN", 200)
        monkeypatch.setattr(constraints, "ROWS_A_PART", 500)
        counts.append(star.write_star(spark, staged, folders[1], NOW))
    assert counts[0] == counts[1] and counts[0][FACT_ORDERS.table] == 1_000
    for target in TARGETS:
        assert texts_of(spark, target, folders[0]) == texts_of(spark, target, folders[1])


def test_runs_shuffle_a_share_each(spark, tables, monkeypatch):
    """No run of the fact takes all orders and items, on either side of a join."""
    monkeypatch.setattr(keys, "ROWS_A_RUN", 200)
    parts = []

    def rows(spark, staged, folder):
        parts.append([staged[t.table].count() for t in (ORDERS, ORDER_ITEMS)])
        return made(spark, staged, folder)

    made = star.fact_rows
    monkeypatch.setattr(star, "fact_rows", rows)
    with session.strict(spark):
        star.write_star(spark, queries.samples.staging(spark, tables), workspace.scratch(spark, "star"), NOW)
    assert len(parts) > 2
    assert [sum(sizes) for sizes in zip(*parts)] == [300, 1_000]
    assert max(orders for orders, _ in parts) < 200


@pytest.mark.parametrize("key", [("s",), ("s", "n")])
def test_runs_hold_every_row_once_and_in_order(spark, key):
    name = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(F.lit("é`\\'"), F.col("id")))
    df = spark.range(3_000).select(name.alias("s"), F.col("id").cast("int").alias("n"))
    found = ranges.drawn(df, key, 640)
    assert found.rows == 3_000 and len(found.keys) == 640
    runs = found.ranges(40, 16).narrowed().runs(5)
    assert 2 < len(runs) <= 5
    rows = [sorted((r.s is not None, (r.s or "").encode()) for r in run.of(df, "s").collect()) for run in runs]
    assert sum(map(len, rows)) == 3_000
    assert all(a[-1] < b[0] for a, b in zip(rows, rows[1:]))
    assert sum(run.ranges.count for run in runs) >= 0.8 * found.ranges(40, 16).narrowed().count
    for run in runs:
        dealt = ranges.deal(run.of(df, "s"), run.ranges, key)
        assert dealt.select(ranges.RANGE).distinct().count() > run.ranges.count // 2


def test_no_rows_are_one_run(spark):
    df = spark.createDataFrame([], "s string")
    (run,) = keys.key_runs(df, ("s",))
    assert run.low is None and run.high is None and run.of(df, "s").count() == 0


def test_broken_rules_are_counted_over_all_runs(spark, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_A_RUN", 100)
    rows = [(f"c{n}", None, None, None, "abc" if n % 50 == 0 else "ab") for n in range(400)]
    staged = texts(CUSTOMERS.columns, *rows)
    with pytest.raises(constraints.ConstraintError, match=r"max_length\(state\): 8 violations"):
        star.write_dimensions(spark, {CUSTOMERS.table: staged}, str(tmp_path / "a"), NOW, (DIM_CUSTOMERS,))


def test_keys_are_checked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(constraints, "ROWS_A_PART", 100)
    once = spark.range(300).select((F.col("id") + 1).alias("customer_key"), F.concat(F.lit("c"), F.col("id") % 290).alias("customer_id"))
    table = {DIM_CUSTOMERS.table: once}
    with pytest.raises(constraints.ConstraintError, match=r"unique\(customer_id\): 10 violations"):
        constraints.enforce_keys(table, (DIM_CUSTOMERS,), rows=300)
    constraints.enforce_keys({DIM_CUSTOMERS.table: once.where("customer_key <= 290")}, (DIM_CUSTOMERS,), rows=300)
