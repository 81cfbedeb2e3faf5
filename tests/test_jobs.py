from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from pathlib import Path

import pytest

from starloom import files
from starloom.jobs import history, load as job, publish
from starloom.jobs.ingest import ingest
from starloom.jobs.transform import transform
from starloom.jobs.validate import validate
from starloom.operators.quality import QualityError
from starloom.schemas import (
    CUSTOMERS,
    DIM_CUSTOMERS,
    FACT_ORDERS,
    ORDER_ITEMS,
    ORDERS,
    PRODUCTS,
    SOURCES,
    TARGETS,
)

FILES = {
    ORDERS: "shop_orders_dataset.csv",
    ORDER_ITEMS: "shop_order_items_dataset.csv",
    CUSTOMERS: "shop_customers_dataset.csv",
    PRODUCTS: "shop_products_dataset.csv",
}

ROWS = {
    ORDERS: ["o1,c1,delivered,2017-10-02 10:56:33,,,2017-10-10 21:25:13,2017-10-18 00:00:00"],
    ORDER_ITEMS: ["o1,1,p1,s1,2017-10-06 11:07:15,29.99,8.72"],
    CUSTOMERS: ["c1,u1,03149,sao paulo,SP"],
    PRODUCTS: ["p1,perfumaria,40,287,1,225,16,10,14"],
}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()

    def write(changes=None):
        for source, rows in {**ROWS, **(changes or {})}.items():
            lines = [",".join(source.columns), *rows]
            (folder / FILES[source]).write_text("\n".join(lines) + "\n")
        return str(folder)

    write()
    return write


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "mart")


def stored(spark, root, target):
    return publish.warehouse(spark, root).read(target.table, target.schema).collect()


def staged(spark, root, source):
    return publish.staging(spark, root).read(source.table, source.schema).collect()


def test_whole_load(spark, raw, root):
    times = job.load(spark, root, raw())
    assert [t.stage for t in times] == ["ingest", "validate", "transform"]
    assert all(t.seconds > 0 and t.outcome == "done" for t in times)
    (row,) = stored(spark, root, FACT_ORDERS)
    assert (row.order_item_key, row.order_id, row.delivery_days) == (1, "o1", 8)
    assert str(row.total_revenue) == "38.71"
    (customer,) = stored(spark, root, DIM_CUSTOMERS)
    assert (customer.city, customer.zip_code_prefix) == ("Sao Paulo", "03149")
    assert customer.created_at == row.created_at


def test_row_counts_are_recorded(spark, raw, root):
    counts = ingest(spark, raw({PRODUCTS: ROWS[PRODUCTS] + ["p2" + "," * 8]}), root)
    assert counts == {s.table: 2 if s is PRODUCTS else 1 for s in SOURCES}
    assert transform(spark, root) == {t.table: 2 if t.table == "dim_products" else 1 for t in TARGETS}
    (run,) = publish.warehouse(spark, root).published().collect()
    assert run.row_counts["dim_products"] == 2


def test_a_load_replaces_the_one_before(spark, raw, root):
    job.load(spark, root, raw())
    changed = {
        CUSTOMERS: ["c0,u0,,,", "c1,u1,99999,rio,RJ"],
        ORDERS: [ROWS[ORDERS][0].replace("o1,", "o9,")],
        ORDER_ITEMS: [ROWS[ORDER_ITEMS][0].replace("o1,", "o9,")],
    }
    job.load(spark, root, raw(changed))
    customers = stored(spark, root, DIM_CUSTOMERS)
    # No history is kept and the keys start at one again.
    assert [(r.customer_key, r.customer_id, r.city) for r in customers] == [
        (1, "c0", None),
        (2, "c1", "Rio"),
    ]
    assert [(r.order_item_key, r.order_id) for r in stored(spark, root, FACT_ORDERS)] == [(1, "o9")]
    assert len(staged(spark, root, ORDERS)) == 1


def test_failed_ingest_keeps_all_staged_tables(spark, raw, root):
    folder = raw()
    ingest(spark, folder, root)
    raw({ORDERS: [ROWS[ORDERS][0].replace("o1,", "o2,")], PRODUCTS: ["p1,x,1,1,1,1,1,1,1,extra"]})
    with pytest.raises(Exception, match="more fields than its header"):
        ingest(spark, folder, root)
    assert [r.order_id for r in staged(spark, root, ORDERS)] == ["o1"]


def test_missing_file_stages_nothing(spark, raw, root):
    folder = raw()
    (Path(folder) / FILES[PRODUCTS]).unlink()
    with pytest.raises(FileNotFoundError, match=r"File not found: .*products_dataset.csv"):
        ingest(spark, folder, root)
    assert publish.staging(spark, root).current_run() is None


def test_failed_gate_leaves_new_staging_and_old_warehouse(spark, raw, root):
    job.load(spark, root, raw())
    with pytest.raises(QualityError, match="duplicate found in primary keys"):
        job.load(spark, root, raw({CUSTOMERS: ["c1,new,,,", "c1,new,,,"]}))
    assert [r.customer_unique_id for r in staged(spark, root, CUSTOMERS)] == ["new", "new"]
    assert [r.customer_unique_id for r in stored(spark, root, DIM_CUSTOMERS)] == ["u1"]


def test_failed_transform_keeps_the_whole_warehouse(spark, raw, root):
    job.load(spark, root, raw())
    # The customers are fine and are built first; the bad price is found in the fact.
    bad = {CUSTOMERS: ["c1,new,,,"], ORDER_ITEMS: ["o1,1,p1,s1,,cheap,1"]}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        job.load(spark, root, raw(bad))
    assert [r.customer_unique_id for r in stored(spark, root, DIM_CUSTOMERS)] == ["u1"]
    assert len(publish.warehouse(spark, root).published().collect()) == 1


def test_earlier_runs_stay_readable(spark, raw, root):
    ingest(spark, raw(), root)
    layer = publish.staging(spark, root)
    first = layer.current_run()
    reader = layer.read(CUSTOMERS.table, CUSTOMERS.schema)
    ingest(spark, raw({CUSTOMERS: ["c5,u5,,,"]}), root)
    assert layer.current_run() != first
    assert [r.customer_id for r in reader.collect()] == ["c1"]


def test_stages_on_their_own(spark, raw, root):
    with pytest.raises(LookupError, match="nothing published"):
        validate(spark, root)
    ingest(spark, raw(), root)
    assert len(validate(spark, root)) == 19
    assert transform(spark, root)["fact_orders"] == 1


def test_other_file_patterns(spark, raw, root):
    folder = Path(raw())
    (folder / "orders").mkdir()
    (folder / FILES[ORDERS]).rename(folder / "orders" / "a.csv")
    counts = ingest(spark, str(folder), root, {"stg_orders": "orders/*.csv"})
    assert counts["stg_orders"] == 1


def test_failing_stage_is_named_and_raised(caplog):
    done = []
    with pytest.raises(KeyError), job.recorded("ingest", done):
        raise KeyError("x")
    assert "ingest failed" in caplog.text
    assert [(s.stage, s.outcome, s.error) for s in done] == [("ingest", "failed", "KeyError: 'x'")]


def test_loads_are_kept_with_their_stages(spark, raw, root):
    job.load(spark, root, raw({PRODUCTS: ROWS[PRODUCTS] + ["p2" + "," * 8]}))
    with pytest.raises(QualityError):
        job.load(spark, root, raw({CUSTOMERS: ["c1,u,,,"] * 2}))
    kept = history.loads(spark, root).orderBy("load", "position").collect()
    assert [(r.load, r.stage, r.outcome) for r in kept] == [
        (1, "ingest", "done"),
        (1, "validate", "done"),
        (1, "transform", "done"),
        (2, "ingest", "done"),
        (2, "validate", "failed"),
    ]
    assert all(r.seconds > 0 for r in kept) and "duplicate found in primary keys" in kept[-1].error
    counts = {(r.load, r.stage, r.table_name): r.row_count for r in history.row_counts(spark, root).collect()}
    assert counts[1, "ingest", "stg_products"] == counts[1, "validate", "stg_products"] == 2
    assert counts[1, "transform", "dim_products"] == 2 and counts[2, "ingest", "stg_customers"] == 2
    assert (2, "validate", "stg_customers") not in counts


def test_failed_loads_leave_nothing(spark, raw, root):
    job.load(spark, root, raw())
    before = sorted(p.name for p in Path(root).glob("*/run=*"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        job.load(spark, root, raw({ORDER_ITEMS: ["o1,1,p1,s1,,cheap,1"]}))
    after = sorted(p.name for p in Path(root).glob("warehouse/run=*"))
    assert set(after) < set(before)
    shared = Path(job.workspace.shared_folder(spark)) / "starloom" / spark.sparkContext.applicationId
    assert not list(shared.glob("fact_orders-*"))


def test_replaced_runs_are_dropped_on_request(spark, raw, root):
    for _ in range(2):
        job.load(spark, root, raw())
    assert len(list(Path(root).glob("*/run=*"))) == 4
    assert len(publish.drop_replaced(spark, root)) == 2
    assert len(list(Path(root).glob("*/run=*"))) == 2
    assert len(stored(spark, root, FACT_ORDERS)) == 1
    job.load(spark, root, stages=("drop-replaced",))


def test_a_run_being_read_survives_a_drop(spark, raw, root):
    layer = publish.staging(spark, root)
    with pytest.raises(LookupError, match="nothing published"), layer.reading():
        pass
    ingest(spark, raw(), root)
    with layer.reading() as run:
        rows = layer.read(CUSTOMERS.table, CUSTOMERS.schema, run)
        ingest(spark, raw({CUSTOMERS: ["c5,u5,,,"]}), root)
        assert layer.drop_replaced() == []
        assert [r.customer_id for r in rows.collect()] == ["c1"]
    assert layer.drop_replaced() == [run]
    with pytest.raises(LookupError, match="has been dropped"), layer.reading(run):
        pass
    with layer.reading() as run:
        assert run == layer.current_run()


def test_a_lease_ends_by_itself_and_a_load_in_progress_is_kept(spark, raw, root):
    layer = publish.staging(spark, root)
    ingest(spark, raw(), root)
    ended = layer.reading(hours=-1)
    first = ended.__enter__()
    ingest(spark, raw(), root)
    with layer.new_load() as run:
        spark.range(3).write.parquet(f"{layer.run_folder(run)}/t")
        assert layer.drop_replaced() == [first]
        assert spark.read.parquet(f"{layer.run_folder(run)}/t").count() == 3


def test_readers_and_drops_at_the_same_time(spark, root):
    """Whoever has a lease finds the run's files, however the runs come and go."""
    layer = publish.staging(spark, root)

    def publish_one(i):
        with layer.new_load() as run:
            files.create_new(spark, f"{layer.run_folder(run)}/t", run)
            layer.publish(run, {})

    def read_one(i):
        with layer.reading() as run:
            return files.read_text(spark, f"{layer.run_folder(run)}/t") == run

    publish_one(0)
    work = [publish_one, read_one, lambda i: layer.drop_replaced(), read_one]
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda i: work[i % 4](i), range(80)))
    assert all(found[i] is True for i in range(80) if i % 4 in (1, 3))


def test_transform_takes_the_run_that_was_validated(spark, raw, root):
    ingest(spark, raw(), root)
    run = publish.staging(spark, root).current_run()
    ingest(spark, raw({ORDERS: []}), root)
    assert len(validate(spark, root, run)) == 19
    assert transform(spark, root, run)["fact_orders"] == 1


def test_the_number_of_a_run_decides_and_no_clock(spark, raw, root, monkeypatch):
    ingest(spark, raw(), root)
    monkeypatch.setattr(publish.temporal, "now", lambda: datetime(1999, 1, 1))
    ingest(spark, raw({CUSTOMERS: ["c5,u5,,,"]}), root)
    assert [r.customer_id for r in staged(spark, root, CUSTOMERS)] == ["c5"]


def test_loads_at_the_same_time_are_all_published(spark, root):
    """Numbers 1 to N without a gap, each of one load, whole whenever it can be seen."""
    layer = publish.staging(spark, root)
    names = [f"run{i}" for i in range(24)]
    seen = []

    def work(name):
        number = publish.staging(spark, root).publish(name, {"t": int(name[3:])})
        seen.append(layer.latest())
        return number

    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(work, names))
    assert sorted(numbers) == list(range(1, 25))
    rows = {r.sequence: (r.run_id, r.row_counts) for r in layer.published().collect()}
    assert rows == {n: (name, {"t": int(name[3:])}) for n, name in zip(numbers, names)}
    assert all(m.run_id in names for m in seen)
    assert layer.latest().sequence == 24 and layer.current_run() == rows[24][0]
    assert not [p for p in Path(f"{root}/staging/manifests").iterdir() if not p.name.endswith((".json", ".crc"))]


def test_a_load_on_what_was_current_does_not_replace_a_later_one(spark, root):
    layer = publish.warehouse(spark, root)
    assert layer.publish("a", {}, after=0) == 1
    assert layer.publish("b", {}) == 2
    with pytest.raises(publish.PublishConflict, match="layer warehouse: number 2 came after number 1"):
        layer.publish("c", {}, after=1)
    assert layer.current_run() == "b"


def test_whole_loads_at_the_same_time(spark, raw, root):
    folder = raw()
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda _: ingest(spark, folder, root), range(3)))
    layer = publish.staging(spark, root)
    assert [r.sequence for r in layer.published().orderBy("sequence").collect()] == [1, 2, 3]
    assert len(staged(spark, root, ORDERS)) == 1


def test_a_manifest_without_its_text_is_not_published(spark, root):
    layer = publish.staging(spark, root)
    layer.publish("a", {"t": 1})
    Path(f"{root}/staging/manifests/{2:012d}.json").touch()
    assert layer.current_run() == "a"
    assert layer.publish("b", {"t": 2}) == 3
    assert layer.current_run() == "b"


@pytest.fixture
def keep_session(spark, monkeypatch):
    monkeypatch.setattr(job.session, "build_session", lambda **_: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)


def test_exit_status(spark, raw, root, keep_session):
    folder = raw()
    assert job.main(["all", "--raw", folder, "--root", root]) == 0
    assert job.main(["validate", "--root", root]) == 0
    raw({ORDERS: []})
    assert job.main(["all", "--raw", folder, "--root", root]) == 1
    assert job.main(["ingest", "--raw", folder + "/none", "--root", root]) == 1


def test_shuffles_grow_with_the_staged_data(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for size, count in ((0, int(before)), (2**30, 32), (10 * 2**40, 327_680)):
        with job.session.sized_shuffles(spark, size) as used:
            assert used == count == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_sql_on_the_published_tables(spark, raw, root):
    ingest(spark, raw(), root)
    assert publish.register(spark, root) == [f"staging.{t}" for t in sorted(s.table for s in SOURCES)]
    transform(spark, root)
    assert len(publish.register(spark, root)) == 8
    query = """
        SELECT t.full_date, p.category_name, sum(f.total_revenue) AS revenue
        FROM warehouse.fact_orders f
        JOIN warehouse.dim_time t ON f.time_key = t.time_key
        JOIN warehouse.dim_products p ON f.product_key = p.product_key
        GROUP BY t.full_date, p.category_name"""
    assert [str(v) for v in spark.sql(query).first()] == ["2017-10-02", "Perfumaria", "38.71"]
    # A later load shows after the views are made anew.
    job.load(spark, root, raw({PRODUCTS: ["p1,other" + "," * 7]}))
    publish.register(spark, root)
    assert spark.sql(query).first().category_name == "Other"
