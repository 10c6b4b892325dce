"""Batch pipeline: raw -> silver (staging) -> gold (dimensions, fact).

Each layer is written as Parquet under one run folder inside the shared
checkpoint folder and read back by the next layer, so lineage is cut at every
layer (a lost executor recomputes from the last written table, never from
raw) and a re-run with the same input rewrites identical tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import report_states, star
from ..operators.id_index import IdStore
from ..operators.staging import stage_customers, stage_orders, stage_products
from ..schemas import CUSTOMERS_RAW, FACT, FACT_COLS, NEW_ORDERS, ORDERS_RAW, PRODUCTS_RAW
from ..sources.files import CSV_SEQ, optional_table, read_csv_raw, split_rejects
from ..session import apply_defaults, landed, new_run_dir, sized

SILVER = ("stg_orders", "stg_customers", "stg_products")
GOLD = ("dim_customers", "dim_products", "fact_orders")


@dataclass
class RawInputs:
    """Bronze feeds.  ``orders`` holds text columns plus the ``seq`` columns;
    ``order_ids`` is as ``stage_orders`` takes it.  ``landed``: the frames read
    written tables, not the files."""

    orders: DataFrame
    seq: tuple[str, ...]
    customers: DataFrame
    products: DataFrame
    app_orders: DataFrame | None = None
    order_ids: DataFrame | None = None
    rejects: dict[str, DataFrame] = field(default_factory=dict)
    landed: bool = False


def csv_inputs(
    spark: SparkSession,
    orders_path: str,
    customers_path: str,
    products_path: str,
    app_orders: str | None = None,
) -> RawInputs:
    """Bronze from header CSV files (every field text) plus the optional
    accepted-orders table (catalog name or parquet path; missing = empty).

    Records that lack a needed field are kept aside in ``rejects``.  The records
    are written once, well-formed or not, and both are taken from that copy: no
    line is put together and split again for each reader.
    """
    rejects = {}
    frames = {}
    for name, path, schema in (("orders", orders_path, ORDERS_RAW), ("customers", customers_path, CUSTOMERS_RAW),
                               ("products", products_path, PRODUCTS_RAW)):
        good, bad = split_rejects(landed(read_csv_raw(spark, path, schema), f"bronze-{name}"))
        frames[name], rejects[name] = good, bad
    return RawInputs(
        orders=frames["orders"],
        seq=CSV_SEQ,
        customers=frames["customers"].drop(*CSV_SEQ),
        products=frames["products"].drop(*CSV_SEQ),
        app_orders=optional_table(spark, app_orders, NEW_ORDERS),
        rejects=rejects,
        landed=True,
    )


@dataclass
class Warehouse:
    """Written silver and gold tables of one run."""

    spark: SparkSession
    root: str
    extra: dict[str, DataFrame] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """The written table.  Tables of a run never change once written, so
        the DataFrame (and its file listing) is kept for later reads."""
        if name not in self.extra:
            if name == "fact_orders":
                # declared schema: the partition column keeps its text type
                df = self.spark.read.schema(FACT).parquet(self.path(name)).select(*FACT_COLS)
            else:
                df = self.spark.read.parquet(self.path(name))
            self.extra[name] = df
        return self.extra[name]

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> None:
        """Overwrite one table of the run."""
        self.extra.pop(name, None)
        _write(df, self.path(name), partition_by)

    @property
    def stg_orders(self) -> DataFrame:
        return self.table("stg_orders")

    @property
    def stg_customers(self) -> DataFrame:
        return self.table("stg_customers")

    @property
    def stg_products(self) -> DataFrame:
        return self.table("stg_products")

    @property
    def dim_customers(self) -> DataFrame:
        return self.table("dim_customers")

    @property
    def dim_products(self) -> DataFrame:
        return self.table("dim_products")

    @property
    def fact_orders(self) -> DataFrame:
        return self.table("fact_orders")

    def v_orders_full(self) -> DataFrame:
        return star.orders_full(self.fact_orders, self.dim_customers, self.dim_products)

    @property
    def ids(self) -> IdStore:
        """The fact's order ids by hash bucket, laid out on first use."""
        store = IdStore(self.spark, self.path("order_ids"))
        with sized(self.spark, self.fact_orders.count()):
            store.start(self.fact_orders)
        return store

    def state(self, name: str) -> DataFrame:
        """Partial sums of the fact (see ``report_states``), written once."""
        table = f"state_{name}"
        if table not in self.extra:
            if not IdStore(self.spark, self.root).has(table):
                with sized(self.spark, self.fact_orders.count()):
                    self.write(table, report_states.partials(self.fact_orders, name, self.dim_customers, self.dim_products))
        return self.table(table)

    def publish(self, database: str | None = None) -> list[str]:
        """Name the written tables in the catalog (the CREATE TABLE AS
        variant), with the wide view over them; data stays where the run wrote
        it.  A table that is there already is switched to this run's folder in
        one step, so readers find the old rows or the new ones, and a run that
        failed before has changed nothing.  Partitions are found in the folder,
        not kept in the catalog, so the switch is whole for the fact too."""
        spark, names, dot = self.spark, [], f"{database}." if database else ""
        keep = "spark.sql.hive.manageFilesourcePartitions"
        before = spark.conf.get(keep)
        for t in (*SILVER, *GOLD):
            self.table(t)  # every table of the run is there before the first switch
        for t in (*SILVER, *GOLD):
            name, path = dot + t, self.path(t)
            if spark.catalog.tableExists(name):
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            else:
                try:
                    spark.conf.set(keep, "false")
                    spark.catalog.createTable(name, path=path, source="parquet", schema=self.table(t).schema) if t != "fact_orders" else spark.sql(
                        f"CREATE TABLE {name} ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in FACT.fields)}) USING parquet PARTITIONED BY (year_month) LOCATION '{path}'"
                    )
                finally:
                    spark.conf.set(keep, before)
            spark.catalog.refreshTable(name)
            names.append(name)
        view = f"{dot}v_orders_full"
        spark.sql(
            f"CREATE OR REPLACE VIEW {view} AS SELECT f.order_id, f.order_date, f.year, f.month, f.year_month, f.channel, f.quantity, f.unit_price, f.revenue, f.gross_profit, f.margin_pct, "
            f"f.customer_id, c.name AS customer_name, c.country, c.segment, f.sku, p.category, p.cost AS product_cost, p.active AS product_active "
            f"FROM {dot}fact_orders f JOIN {dot}dim_customers c ON f.customer_id = c.customer_id JOIN {dot}dim_products p ON f.sku = p.sku"
        )
        return [*names, view]

    def register_views(self, prefix: str = "") -> list[str]:
        """Temp views over the written tables plus ``v_orders_full``, so the
        star schema can be queried with ``spark.sql``."""
        names = []
        for t in (*SILVER, *GOLD):
            self.table(t).createOrReplaceTempView(prefix + t)
            names.append(prefix + t)
        self.v_orders_full().createOrReplaceTempView(prefix + "v_orders_full")
        return names + [prefix + "v_orders_full"]


def _write(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def land_bronze(raw: RawInputs, wh: Warehouse) -> RawInputs:
    """Write file orders (text columns + file-order sequence) once as Parquet
    and continue from that copy.  The duplicate check reads its input twice
    (a key count, then the rows); from Parquet the first read is one column
    instead of re-tokenising every CSV line, and the sequence columns are
    fixed on disk instead of being recomputed per read."""
    wh.write("bronze_orders", raw.orders)
    return RawInputs(
        orders=wh.table("bronze_orders"),
        seq=raw.seq,
        customers=raw.customers,
        products=raw.products,
        app_orders=raw.app_orders,
        rejects=raw.rejects,
    )


def load_staging(raw: RawInputs, wh: Warehouse, **skew) -> None:
    """Write the three staging tables (every input row, typed and flagged)
    and, for file input, the malformed lines."""
    for name, bad in raw.rejects.items():
        wh.write(f"rejects_{name}", bad)
    wh.write("stg_orders", stage_orders(raw.orders, raw.app_orders, raw.seq, order_ids=raw.order_ids, **skew))
    wh.write("stg_customers", stage_customers(raw.customers))
    wh.write("stg_products", stage_products(raw.products))


def load_consumption(wh: Warehouse, check_dates: bool = True) -> None:
    """Check dimension keys, then write dimensions and the fact.

    A duplicate dimension key stops the run before any gold table is
    written (staging stays, as in the source pipeline).
    """
    star.assert_unique(wh.stg_customers, "customer_id", "dim_customers")
    star.assert_unique(wh.stg_products, "sku", "dim_products")
    wh.write("dim_customers", star.dim_customers(wh.stg_customers))
    wh.write("dim_products", star.dim_products(wh.stg_products))
    fact = star.fact_orders(wh.stg_orders, wh.dim_products, check_dates, by_month=True)
    with sized(wh.spark, wh.stg_orders.count()):
        wh.write("fact_orders", fact, partition_by="year_month")


def run_batch(spark: SparkSession, raw: RawInputs, root: str | None = None, check_dates: bool = True,
              **skew) -> Warehouse:
    """Full batch: staging then consumption.  Returns the written tables."""
    apply_defaults(spark)
    wh = Warehouse(spark, root or new_run_dir(spark, "warehouse"))
    if raw.landed:
        wh.extra["bronze_orders"] = raw.orders
    elif tuple(raw.seq) == CSV_SEQ:
        raw = land_bronze(raw, wh)
    load_staging(raw, wh, **skew)
    load_consumption(wh, check_dates)
    return wh


def existing_order_ids(wh: Warehouse, *others: DataFrame) -> DataFrame:
    """Ids that block a new registration: the fact plus accepted orders."""
    ids = wh.fact_orders.select("order_id")
    for o in others:
        ids = ids.unionByName(o.select("order_id"))
    return ids


def id_lookup(wh: Warehouse, *others: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """The same for given ids: of the fact, only their buckets are read."""
    store = wh.ids

    def ids(wanted: DataFrame) -> DataFrame:
        out = store.lookup(wanted)
        for o in others:
            out = out.unionByName(o.select("order_id"))
        return out

    return ids


def live_state(wh: Warehouse, name: str, *registered: DataFrame) -> DataFrame:
    """The state ``name`` of the fact and of orders accepted since, for the
    KPI functions.  The fact is not scanned: its partial sums are merged with
    the accepted orders', and the ids that a later batch has loaded are looked
    up in their buckets."""
    states = [wh.state(name)]
    for r in registered:
        log = r.select(*FACT_COLS)
        new = log.join(wh.ids.lookup(log), "order_id", "left_anti")
        states.append(report_states.partials(new, name, wh.dim_customers, wh.dim_products))
    return report_states.merged(name, *states)


def live_fact_orders(wh: Warehouse, *registered: DataFrame) -> DataFrame:
    """The fact as reports see it between batch runs: the written fact plus
    orders accepted since (their rows already carry the fact measures).  An
    accepted order that a later batch has loaded is in the fact already and is
    not counted again.  Only the fact ids that the log names are joined."""
    fact = wh.fact_orders
    for r in registered:
        log = r.select(*FACT_COLS)
        loaded = fact.select("order_id").join(log.select("order_id"), "order_id", "left_semi").distinct()
        fact = fact.unionByName(log.join(loaded, "order_id", "left_anti"))
    return fact


def as_new_orders(df: DataFrame) -> DataFrame:
    """Project registered / app orders onto the accepted-order columns."""
    return df.select(
        F.col("order_id"),
        F.col("customer_id"),
        F.col("sku"),
        F.col("quantity").cast("int"),
        F.col("unit_price").cast("double"),
        F.col("order_date").cast("date"),
        F.col("channel"),
        F.col("created_at"),
    )
