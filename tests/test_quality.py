import pytest

from starloom.operators import quality
from starloom.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, SOURCES


def good_rows():
    return {
        ORDERS: [("o1", "c1", "ok", "2017-01-01 00:00:00", None, None, None, None)],
        ORDER_ITEMS: [("o1", "1", "p1", None, None, "1.00", None)],
        CUSTOMERS: [("c1", "u1", None, None, None)],
        PRODUCTS: [("p1", *[None] * 8)],
    }


@pytest.fixture
def staged(texts):
    def make(changes=None):
        rows = {**good_rows(), **(changes or {})}
        return {s.table: texts(s.columns, *rows[s]) for s in SOURCES}

    return make


def failure(frames):
    with pytest.raises(quality.QualityError) as caught:
        quality.enforce(frames, SOURCES)
    return str(caught.value)


def test_all_good(staged):
    rows = quality.enforce(staged(), SOURCES)
    assert len(rows) == 19
    assert [r.position for r in rows] == list(range(19))
    assert all(r.passed for r in rows)


def test_empty_table(staged):
    assert failure(staged({ORDERS: []})) == "staging.stg_orders is empty"


def test_all_null_columns_are_listed(staged):
    good = good_rows()[ORDERS][0]
    bad = [good, (None, None, *good[2:]), ("o2", None, *good[2:])]
    assert failure(staged({ORDERS: bad})) == (
        "staging.stg_orders null check failed:\norder_id: 1 null rows\ncustomer_id: 2 null rows"
    )


def test_null_counts_have_thousands_separators(spark, staged):
    frames = staged()
    many = frames[PRODUCTS.table].limit(0).union(
        spark.range(1_234).selectExpr(*["cast(null as string)"] * len(PRODUCTS.columns))
    )
    frames[PRODUCTS.table] = many
    assert "product_id: 1,234 null rows" in failure(frames)


def test_blank_text_is_not_null(staged):
    good = good_rows()[ORDER_ITEMS][0]
    quality.enforce(staged({ORDER_ITEMS: [(*good[:5], "   ", None)]}), SOURCES)


def test_duplicate_composite_key(staged):
    good = good_rows()[ORDER_ITEMS][0]
    assert failure(staged({ORDER_ITEMS: [good, good]})) == (
        "staging.stg_order_items duplicate found in primary keys:\n    ('o1', '1', 2)"
    )


def test_most_repeated_key_first(staged):
    good = good_rows()[CUSTOMERS][0]
    twice, thrice = [("c8", "u", *good[2:])] * 2, [("c9", "u", *good[2:])] * 3
    message = failure(staged({CUSTOMERS: twice + thrice}))
    assert message.endswith("\n    ('c9', 3)\n    ('c8', 2)")


def test_long_duplicate_lists_are_stored_whole(spark, staged, tmp_path):
    rows = [(f"c{i % 30:02}", "u", None, None, None) for i in range(60)]
    frames = staged({CUSTOMERS: rows})
    folder = str(tmp_path / "duplicates")
    with pytest.raises(quality.QualityError) as caught:
        quality.enforce(frames, SOURCES, folder)
    message = str(caught.value)
    assert message.count("('c") == quality.SHOWN_DUPLICATES
    assert message.endswith(f"and 10 more\n    all of them: {folder}/stg_customers")
    assert spark.read.parquet(f"{folder}/stg_customers").count() == 30
    assert quality.ranked_duplicates(frames[CUSTOMERS.table], CUSTOMERS.primary_key).count() == 30


def test_first_failure_in_table_and_check_order(staged):
    good = good_rows()[ORDERS][0]
    # Orders have NULLs and duplicates, products are empty: the NULLs come first.
    bad = {ORDERS: [good, good, (*good[:2], None, good[3], *[None] * 4)], PRODUCTS: []}
    assert failure(staged(bad)).startswith("staging.stg_orders null check failed")


def test_nulls_in_one_pass(staged):
    counted = quality.null_counts(staged()[ORDERS.table], "stg_orders", ORDERS.columns)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert {r.column_name: r.null_rows for r in counted.collect()}["order_approved_at"] == 1
