"""The registered queries, each over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom import files, session, workspace
from starloom.functions import numeric, temporal, text
from starloom.jobs import history, ingest, load, publish
from starloom.operators import constraints, keys, quality
from starloom.plans import dimensions, fact, reports, star
from starloom.schemas import (
    CUSTOMERS,
    DIM_CUSTOMERS,
    DIM_PRODUCTS,
    DIM_TIME,
    DIMENSIONS,
    FACT_ORDERS,
    ORDER_ITEMS,
    ORDERS,
    PRODUCTS,
    SOURCES,
    TARGETS,
    Source,
    Target,
)
from starloom.sources import csv_files, sample_tables as samples

Query = Callable[[SparkSession, str], DataFrame]


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _without_load_time(spark: SparkSession, folder: str, target: Target) -> DataFrame:
    return star.read_table(spark, folder, target).drop("created_at")


def _dimension(target: Target, staged: Callable[[SparkSession, str], dict]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = workspace.scratch(spark, target.table)
        star.write_dimensions(spark, staged(spark, sf_dir), folder, temporal.now(), (target,))
        return _without_load_time(spark, folder, target)

    return query


Changed = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


@contextmanager
def _passing(spark: SparkSession, sf_dir: str) -> Iterator[None]:
    """For queries run meanwhile: enough shuffle partitions for the tables the feeds are made
    of, and no shuffle file stays longer than its query."""
    size = sum(files.total_length(spark, f"{sf_dir}/{name}.parquet") for name in samples.TABLES)
    with session.sized_shuffles(spark, size), session.passing_shuffles(spark):
        yield


def _written_star(spark: SparkSession, sf_dir: str, changed: Changed = dict) -> str:
    lines, folder = (workspace.scratch(spark, label) for label in ("order-lines", "star"))
    with _passing(spark, sf_dir):
        staged = changed(samples.staging(spark, sf_dir, place=lines))
        star.write_star(spark, staged, folder, written=lambda: workspace.discard(spark, lines))
    return folder


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_load_time(spark, _written_star(spark, sf_dir), FACT_ORDERS)


def revenue_by_month_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _written_star(spark, sf_dir)
    tables = [star.read_table(spark, folder, t) for t in (FACT_ORDERS, DIM_PRODUCTS, DIM_TIME)]
    return reports.revenue_by_month_category(*tables)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    natural_keys = {
        DIM_CUSTOMERS: samples.customers(spark, sf_dir).select("customer_id"),
        DIM_PRODUCTS: samples.products(spark, sf_dir).select("product_id"),
        DIM_TIME: dimensions.purchase_dates(samples.orders(spark, sf_dir)),
    }

    def numbered(target: Target, rows: DataFrame) -> DataFrame:
        (natural,) = target.natural_key
        return keys.assign_keys(rows, "surrogate_key", (natural,)).select(
            F.lit(target.table).alias("table_name"),
            F.col(natural).cast("string").alias("natural_key"),
            "surrogate_key",
        )

    return _union(numbered(target, rows) for target, rows in natural_keys.items())


# Joins, with some customers and products under ids that no row refers to.


def _gapped(spark: SparkSession, sf_dir: str, raw_item_ids: bool = False) -> dict:
    return samples.with_unknown_parents(samples.staging(spark, sf_dir, raw_item_ids))


def join_items_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = samples.items(spark, sf_dir).select("order_id", "order_item_id", "product_id")
    orders = samples.orders(spark, sf_dir).select("order_id", "customer_id", "order_status")
    return fact.of_known_orders(items, orders)


def _gapped_dimensions(spark: SparkSession, staged: dict, *targets: Target) -> list[DataFrame]:
    folder = workspace.scratch(spark, "dimensions")
    star.write_dimensions(spark, staged, folder, temporal.now(), targets)
    return [star.read_table(spark, folder, t) for t in targets]


def join_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _gapped(spark, sf_dir)
    (products,) = _gapped_dimensions(spark, staged, DIM_PRODUCTS)
    matched = fact.items_with_keys(staged[ORDER_ITEMS.table], products)
    return matched.select("order_id", "order_item_id", "product_key")


def join_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _gapped(spark, sf_dir, raw_item_ids=True)
    (customers,) = _gapped_dimensions(spark, staged, DIM_CUSTOMERS)
    return fact.with_customer_key(staged[ORDERS.table].select("order_id", "customer_id"), customers)


def join_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to dates on a computed key; every fifth order has no purchase time."""
    orders = samples.orders(spark, sf_dir)
    dated = F.col("order_id").cast("bigint") % 5 != 0
    some = orders.withColumn(
        "order_purchase_timestamp", F.when(dated, F.col("order_purchase_timestamp"))
    )
    (time,) = _gapped_dimensions(spark, {ORDERS.table: some}, DIM_TIME)
    placed = some.select("order_id", "order_purchase_timestamp")
    return fact.with_date_key(placed, time).drop("purchase_timestamp")


def join_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _gapped(spark, sf_dir, raw_item_ids=True)
    return fact.join_losses(
        staged[ORDER_ITEMS.table],
        staged[ORDERS.table],
        *_gapped_dimensions(spark, staged, *DIMENSIONS),
    )


def fact_orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _written_star(spark, sf_dir, samples.with_unknown_parents)
    return _without_load_time(spark, folder, FACT_ORDERS)


# Column functions.


def fn_trim_nullif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.raw_items(spark, sf_dir).select(
        "order_id",
        "order_item_id",
        "product_id",
        text.blank_to_null(F.col("price")).alias("price_text"),
        numeric.money(F.col("price")).alias("price"),
        numeric.money_sum(
            numeric.money(F.col("price")), numeric.money(F.col("freight_value"))
        ).alias("total_revenue"),
    )


def fn_initcap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title case over the cities and over whole document texts."""
    cities = samples.customers(spark, sf_dir).select(
        F.lit("customer").alias("kind"),
        F.col("customer_id").alias("id"),
        text.title_case(F.trim("customer_city")).alias("title"),
    )
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.lit("document").alias("kind"),
        F.col("doc_id").cast("string").alias("id"),
        text.title_case(F.col("text")).alias("title"),
    )
    return cities.unionByName(documents)


def fn_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("full_date")
    orders = samples.orders(spark, sf_dir).withColumn(
        "full_date", temporal.calendar_date(F.col("order_purchase_timestamp"))
    )
    return orders.select(
        "order_id",
        temporal.wall_clock(F.col("order_purchase_timestamp")).alias("purchase_timestamp"),
        temporal.midnight(F.col("order_estimated_delivery_date")).alias("estimated_delivery_date"),
        day,
        F.weekofyear(day).alias("week_of_year"),
        temporal.iso_weekday(day).alias("day_of_week"),
        temporal.month_name(day).alias("month_name"),
        temporal.day_name(day).alias("day_name"),
    )


def delivery_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = temporal.whole_days(
        temporal.wall_clock(F.col("order_purchase_timestamp")),
        temporal.wall_clock(F.col("order_delivered_customer_date")),
    )
    both = (
        F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_purchase_timestamp").isNotNull()
    )
    orders = samples.orders(spark, sf_dir)
    return orders.select("order_id", F.when(both, days).alias("delivery_days"))


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each load filter keeps and drops."""
    staged = samples.with_null_keys(samples.staging(spark, sf_dir, raw_item_ids=True))
    filters = {
        ORDERS: dimensions.purchased,
        ORDER_ITEMS: fact.identified,
        CUSTOMERS: dimensions.customers,
        PRODUCTS: dimensions.products,
    }

    def counted(source: Source, kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
        rows = staged[source.table]
        both = kept(rows).select(F.lit(1).alias("kept")).unionAll(rows.select(F.lit(0).alias("kept")))
        return both.agg(
            F.lit(source.table).alias("table_name"),
            F.count_if(F.col("kept") == 1).alias("kept_rows"),
            (F.count_if(F.col("kept") == 0) - F.count_if(F.col("kept") == 1)).alias("dropped_rows"),
        )

    return _union(counted(s, kept) for s, kept in filters.items())


# Quality checks, on items whose ids repeat.


def _raw(spark: SparkSession, sf_dir: str) -> dict:
    return samples.staging(spark, sf_dir, raw_item_ids=True)


def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _raw(spark, sf_dir)
    return _union(quality.row_count(staged[s.table], s.table) for s in SOURCES)


def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _raw(spark, sf_dir)
    return _union(quality.null_counts(staged[s.table], s.table, s.columns) for s in SOURCES)


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_groups(samples.raw_items(spark, sf_dir), ORDER_ITEMS.primary_key)


def dq_duplicates_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ranked_duplicates(samples.raw_items(spark, sf_dir), ORDER_ITEMS.primary_key)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_raw(spark, sf_dir), SOURCES)


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared rules, over a written star in whose fact item ids repeat."""
    staged = _raw(spark, sf_dir)
    folder = workspace.scratch(spark, "star")
    now = temporal.now()
    star.write_dimensions(spark, staged, folder, now)
    star.write_fact(spark, staged, folder, now, checked=False)
    tables = {t.table: star.read_table(spark, folder, t) for t in TARGETS}
    return constraints.constraint_report(tables, TARGETS)


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _gapped(spark, sf_dir, raw_item_ids=True)
    links = (
        (ORDER_ITEMS, "order_id", ORDERS),
        (ORDER_ITEMS, "product_id", PRODUCTS),
        (ORDERS, "customer_id", CUSTOMERS),
    )

    def counted(child: Source, column: str, parent: Source) -> DataFrame:
        orphans = constraints.orphan_rows(
            staged[child.table], column, staged[parent.table], column
        )
        rule = F.lit(f"{child.table}.{column} in {parent.table}").alias("rule")
        return orphans.select(rule, "orphan_rows", "orphan_values")

    return _union(counted(*link) for link in links)


# CSV files and staging. The files are written from the staging frames.


def _write_csv(df: DataFrame, place: str) -> str:
    df.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(place)
    return place


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, commas and line ends survive, cities keep their blanks."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("doc_id"), "lang", "text"
    )
    place = _write_csv(documents, workspace.scratch(spark, "documents"))
    return csv_files.read_csv(spark, place, ("doc_id", "lang", "text"))


def csv_missing_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two in three cities replaced by a marker, each marker in turn."""
    markers = F.array(*[F.lit(m) for m in csv_files.MISSING_MARKERS])
    n = F.col("customer_id").cast("bigint")
    turn = (n % len(csv_files.MISSING_MARKERS)).cast("int") + 1
    city = F.when(n % 3 == 0, F.col("customer_city")).otherwise(F.element_at(markers, turn))
    marked = samples.customers(spark, sf_dir).withColumn("customer_city", city)
    place = _write_csv(marked, workspace.scratch(spark, "customers"))
    return csv_files.read_csv(spark, place, CUSTOMERS.columns)


def csv_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in lines that end in every way, with lines of blanks between them."""
    n = F.col("customer_id").cast("bigint")
    customers = samples.customers(spark, sf_dir)
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in customers.columns]
    end = F.when(n % 4 == 0, "\r").when(n % 4 == 1, "\r\n   ").when(n % 4 == 2, "\r\n").otherwise("")
    lines = customers.select(F.concat(F.concat_ws(",", *quoted), end).alias("value"), n.alias("n"))
    header = spark.range(1).select(F.lit(",".join(CUSTOMERS.columns)).alias("value"), F.lit(-1).alias("n"))
    place = workspace.scratch(spark, "customers")
    # A file a partition, each with a header of its own.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = header.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    rows = lines.withColumn("part", (F.col("n") % parts).cast("int"))
    dealt = heads.unionByName(rows).repartition(parts, "part").sortWithinPartitions("part", "n")
    dealt.select("part", "value").write.partitionBy("part").text(place)
    return csv_files.read_csv(spark, f"{place}/part=*", CUSTOMERS.columns)


def stage_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with its columns in another order and one too many."""
    customers = samples.customers(spark, sf_dir)
    shuffled = customers.select(
        *reversed(CUSTOMERS.columns), F.lit("not declared").alias("remark")
    )
    place = _write_csv(shuffled, workspace.scratch(spark, "customers"))
    return csv_files.read_csv(spark, place, CUSTOMERS.columns)


def _staged(source: Source, frame: Callable[[SparkSession, str], DataFrame]) -> Query:
    """One feed written to CSV, read back and staged as the ingest job stages it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        place = _write_csv(frame(spark, sf_dir), workspace.scratch(spark, source.table))
        folder = workspace.scratch(spark, "staging")
        frame_read = csv_files.read_csv(spark, place, source.columns)
        ingest.write_staged(spark, {source.table: frame_read}, folder)
        return spark.read.schema(source.schema).parquet(f"{folder}/{source.table}")

    return query


def stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts the staging writes report."""
    staged = _raw(spark, sf_dir)
    raw = workspace.scratch(spark, "raw")
    frames = {
        s.table: csv_files.read_csv(
            spark, _write_csv(staged[s.table], f"{raw}/{s.table}"), s.columns
        )
        for s in SOURCES
    }
    counts = ingest.write_staged(spark, frames, workspace.scratch(spark, "staging"))
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


# The jobs themselves, on a root folder of their own.


def _loaded(spark: SparkSession, sf_dir: str, changed: Changed = dict) -> str:
    """The root folder of a whole load from CSV files of all four feeds.

    What is written for the load goes as soon as it has been read: the numbered lines once the
    items' file is there, the files once they are staged.
    """
    lines, raw, root = (workspace.scratch(spark, label) for label in ("order-lines", "raw", "mart"))
    with _passing(spark, sf_dir):
        staged = changed(samples.staging(spark, sf_dir, place=lines))
        for source in SOURCES:
            _write_csv(staged[source.table], f"{raw}/{source.table}")
    workspace.discard(spark, lines)
    patterns = {s.table: s.table for s in SOURCES}
    load.load(spark, root, raw, patterns=patterns, ingested=lambda: workspace.discard(spark, raw))
    return root


def load_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of feeds with dangling references keeps of itself: rows by stage and table."""
    return history.row_counts(spark, _loaded(spark, sf_dir, samples.with_unknown_parents))


def full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact after ingest, gate and transform of CSV files of all four feeds."""
    layer = publish.warehouse(spark, _loaded(spark, sf_dir))
    return layer.read(FACT_ORDERS.table, FACT_ORDERS.schema).drop("created_at")


def reload_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads one after the other; the second replaces the first and its keys."""
    base = {CUSTOMERS.table: samples.customers(spark, sf_dir)}
    other = base[CUSTOMERS.table].select(
        F.concat(F.lit("other-"), "customer_id").alias("customer_id"), *CUSTOMERS.columns[1:]
    )
    layer = publish.warehouse(spark, workspace.scratch(spark, "mart"))
    for staged in ({CUSTOMERS.table: other}, base):
        run_id = layer.new_run()
        folder = layer.run_folder(run_id)
        counts = star.write_dimensions(spark, staged, folder, temporal.now(), (DIM_CUSTOMERS,))
        layer.publish(run_id, counts)
    return layer.read(DIM_CUSTOMERS.table, DIM_CUSTOMERS.schema).drop("created_at")


def _strict(query: Query) -> Query:
    """The query whatever the session's own settings for casts and time."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with session.strict(spark):
            return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "revenue_by_month_category": revenue_by_month_category,
    "dim_customers": _dimension(
        DIM_CUSTOMERS, lambda spark, d: {CUSTOMERS.table: samples.customers(spark, d)}
    ),
    "dim_products": _dimension(
        DIM_PRODUCTS, lambda spark, d: {PRODUCTS.table: samples.products(spark, d)}
    ),
    "dim_time": _dimension(DIM_TIME, lambda spark, d: {ORDERS.table: samples.orders(spark, d)}),
    "fact_orders": fact_orders,
    "fact_orders_with_gaps": fact_orders_with_gaps,
    "surrogate_keys": surrogate_keys,
    "join_items_orders": join_items_orders,
    "join_products": join_products,
    "join_customers": join_customers,
    "join_time": join_time,
    "join_losses": join_losses,
    "fn_trim_nullif": fn_trim_nullif,
    "fn_initcap": fn_initcap,
    "fn_dates": fn_dates,
    "delivery_days": delivery_days,
    "filter_not_null": filter_not_null,
    "dq_row_count": dq_row_count,
    "dq_nulls": dq_nulls,
    "dq_duplicates": dq_duplicates,
    "dq_duplicates_top": dq_duplicates_top,
    "dq_report": dq_report,
    "constraint_report": constraint_report,
    "fk_orphans": fk_orphans,
    "csv_scan": csv_scan,
    "csv_missing_markers": csv_missing_markers,
    "csv_line_ends": csv_line_ends,
    "stage_project": stage_project,
    "stage_row_counts": stage_row_counts,
    "stage_orders": _staged(ORDERS, samples.orders),
    "stage_order_items": _staged(ORDER_ITEMS, samples.raw_items),
    "stage_customers": _staged(CUSTOMERS, samples.customers),
    "stage_products": _staged(PRODUCTS, samples.products),
    "full_load": full_load,
    "load_row_counts": load_row_counts,
    "reload_dim_customers": reload_dim_customers,
}

QUERIES: dict[str, Query] = {name: _strict(query) for name, query in _QUERIES.items()}
