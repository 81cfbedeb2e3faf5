"""The feeds made from the generated tables."""

import datetime as dt

from starloom import session
from starloom.sources import sample_tables as samples


def _tables(spark, folder):
    day = dt.date(1995, 3, 1)
    orders = [(k, k % 7, "OFP"[k % 3], day) for k in range(1, 200)] + [(None, 1, "O", day), (5, 2, "F", day)]
    lines = [(k, day + dt.timedelta(days=(k * n) % 40)) for k in range(1, 260, 2) for n in range(1, 5)] + [(None, day), (9, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date").write.parquet(
        f"{folder}/orders.parquet"
    )
    spark.createDataFrame(lines, "l_orderkey long, l_shipdate date").write.parquet(f"{folder}/lineitem.parquet")


def test_large_orders_are_dealt_out_before_they_are_grouped(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    _tables(spark, folder)
    small = samples.orders(spark, folder)
    monkeypatch.setattr(session, "_PARTITION_BYTES", 500)
    large = samples.orders(spark, folder)
    # The lines are grouped behind the one shuffle only, not all orders of a part of a file before it.
    executed = large._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in executed and "ENSURE_REQUIREMENTS" not in executed
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    assert small.count() == 201
