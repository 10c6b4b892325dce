"""Order entry: validate submitted records and register the accepted ones.

Rules, in the order a submission is judged:

1. field rules (all fields at once, at most one error per field):
   required text, integer quantity > 0, numeric price > 0, ``yyyy-m-d`` date
   (whole value), channel in the allowed list;
2. customer must exist in ``dim_customers``;
3. SKU must exist in ``dim_products`` (only checked for a known customer);
4. the order id must be new: the first valid submission of an id wins, and an
   id already in the accepted orders or the fact is refused.

A refused submission leaves no trace, so a later valid submission with the
same id can still be accepted (the opposite of the batch "flag first" rule).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..functions.measures import order_measures, out_of_range, revenue
from ..schemas import ORDER_FIELDS, VALID_CHANNELS
from ..session import landed, sized
from .dedup import flag_repeats

# Error codes reported per field.
REQUIRED = "required"
NOT_INTEGER = "not_integer"
NOT_NUMERIC = "not_numeric"
NOT_POSITIVE = "not_positive"
OUT_OF_RANGE = "out_of_range"
BAD_DATE = "bad_date_format"
BAD_CHANNEL = "invalid_channel"
UNKNOWN_CUSTOMER = "unknown_customer"
UNKNOWN_SKU = "unknown_sku"
DUPLICATE_ID = "duplicate_order_id"

REGISTERED_COLS = (
    "order_id",
    "customer_id",
    "sku",
    "quantity",
    "unit_price",
    "order_date",
    "channel",
    "created_at",
    "year",
    "month",
    "year_month",
    "revenue",
    "gross_profit",
    "margin_pct",
)
REJECTED_COLS = ("seq", "order_id", "field", "code")


def normalize_form(candidates: DataFrame, seq: str = "seq") -> DataFrame:
    """Strip every field (missing -> ''), lower-case the channel."""
    cols = [clean.strip_or_empty(c).alias(c) for c in ORDER_FIELDS if c != "channel"]
    cols.append(F.lower(clean.strip_or_empty("channel")).alias("channel"))
    extra = [c for c in candidates.columns if c not in ORDER_FIELDS]
    return candidates.select(*cols, *[F.col(c) for c in extra])


def _err(field: str, code: Column | str) -> Column:
    code_c = F.lit(code) if isinstance(code, str) else code
    return F.struct(F.lit(field).alias("field"), code_c.alias("code"))


def field_errors(form: DataFrame) -> Column:
    """array<struct<field, code>> of field-rule violations (empty = valid)."""
    blank = {c: F.col(c) == "" for c in ORDER_FIELDS}
    qty = clean.to_int("quantity")
    qty_ok = qty.isNotNull()
    price = clean.to_double("unit_price")
    price_ok = price.isNotNull()
    date_ok = clean.to_date(F.col("order_date"), first_token=False).isNotNull()

    checks = [F.when(blank[c], _err(c, REQUIRED)) for c in ("order_id", "customer_id", "sku")]
    checks.append(
        F.when(blank["quantity"], _err("quantity", REQUIRED))
        .when(~qty_ok, _err("quantity", NOT_INTEGER))
        .when(qty <= 0, _err("quantity", NOT_POSITIVE))
    )
    checks.append(
        F.when(blank["unit_price"], _err("unit_price", REQUIRED))
        .when(~price_ok, _err("unit_price", NOT_NUMERIC))
        .when(price <= 0, _err("unit_price", NOT_POSITIVE))
    )
    checks.append(
        F.when(blank["order_date"], _err("order_date", REQUIRED)).when(~date_ok, _err("order_date", BAD_DATE))
    )
    checks.append(
        F.when(blank["channel"], _err("channel", REQUIRED)).when(
            ~F.col("channel").isin(*VALID_CHANNELS), _err("channel", BAD_CHANNEL)
        )
    )
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def validation_errors(candidates: DataFrame, seq: str = "seq") -> DataFrame:
    """Long form: one (seq, order_id, field, code) row per violated field rule."""
    form = normalize_form(candidates, seq)
    return form.select(seq, "order_id", F.explode(field_errors(form)).alias("e")).select(
        seq, "order_id", "e.field", "e.code"
    )


def _reject(field: str, code: str) -> Column:
    return F.array(_err(field, code))


def _no_rejection() -> Column:
    return F.array().cast("array<struct<field:string,code:string>>")


def assess(
    candidates: DataFrame, dim_customers: DataFrame, dim_products: DataFrame, seq: str = "seq", now: Column | None = None
) -> DataFrame:
    """Steps 1-3 for every submission: typed fields, product cost and
    ``_reject`` (array of (field, code); empty = eligible for an id).
    ``now``: the clock (default: the current time)."""
    form = normalize_form(candidates, seq)
    clock = F.current_timestamp() if now is None else now
    if "created_at" not in form.columns:
        form = form.withColumn("created_at", clock)
    else:  # the default of a submission that does not say
        form = form.withColumn("created_at", F.coalesce("created_at", clock.cast(form.schema["created_at"].dataType)))
    v = form.select(
        F.col(seq).alias("seq"),
        "order_id",
        "customer_id",
        "sku",
        clean.to_int("quantity").alias("quantity"),
        clean.to_double("unit_price").alias("unit_price"),
        clean.to_date(F.col("order_date"), first_token=False).alias("order_date"),
        "channel",
        "created_at",
        field_errors(form).alias("_field_errors"),
    )
    c = dim_customers.select(F.col("customer_id").alias("_c_id"), F.lit(True).alias("_c_hit"))
    p = dim_products.select(F.col("sku").alias("_p_sku"), F.col("cost").alias("_cost"), F.lit(True).alias("_p_hit"))
    j = v.join(c, v["customer_id"] == c["_c_id"], "left").join(p, F.col("sku") == p["_p_sku"], "left")
    reject = (
        F.when(F.size("_field_errors") > 0, F.col("_field_errors"))
        .when(F.col("_c_hit").isNull(), _reject("customer_id", UNKNOWN_CUSTOMER))
        .when(F.col("_p_hit").isNull(), _reject("sku", UNKNOWN_SKU))
        .when(out_of_range(F.col("quantity"), F.col("unit_price"), F.col("_cost")), _reject("unit_price", OUT_OF_RANGE))
        .otherwise(_no_rejection())
    )
    return j.select(
        "seq", "order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel",
        "created_at", "_cost", reject.alias("_reject"),
    )


def decide(assessed: DataFrame, existing_ids: DataFrame, **skew) -> DataFrame:
    """Step 4: the first eligible submission of an id wins unless the id is
    already taken.  Same columns as ``assess``; ``_reject`` final."""
    eligible = assessed.where(F.size("_reject") == 0)
    others = assessed.where(F.size("_reject") > 0)
    flagged = flag_repeats(eligible, "order_id", ["seq"], "_repeat", **skew)
    # Only ids of this batch are looked up among the existing ids: the join
    # filters the (large) id table by the batch's distinct ids, which Spark
    # broadcasts when the batch is small.  A semi-join would be run below the
    # filter of ``existing_ids`` by hash cells, so on all of them.
    taken = (
        existing_ids.select("order_id")
        .join(eligible.select("order_id").distinct(), "order_id")
        .distinct()
        .select(F.col("order_id").alias("_t_id"), F.lit(True).alias("_taken"))
    )
    e = flagged.join(taken, flagged["order_id"] == taken["_t_id"], "left")
    e = e.withColumn(
        "_reject",
        F.when((F.col("_repeat") == 1) | F.col("_taken"), _reject("order_id", DUPLICATE_ID)).otherwise(
            F.col("_reject")
        ),
    ).select(*assessed.columns)
    return others.unionByName(e)


def register_orders(
    candidates: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    existing_ids: DataFrame | Callable[[DataFrame], DataFrame],
    seq: str = "seq",
    checkpoint: bool = False,
    now: Column | None = None,
    **skew,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) for a set of submissions.

    ``candidates``: the seven text fields, an arrival column ``seq`` and,
    optionally, ``created_at`` (else the current time).  ``existing_ids``:
    an ``order_id`` column of ids already registered or in the fact, or a
    function that gives them for the batch's own eligible ids (as
    ``IdStore.lookup`` does, which reads only their buckets).
    ``accepted`` has the accepted-order columns plus the fact measures;
    ``rejected`` has (seq, order_id, field, code), one row per reason.

    ``checkpoint=True`` writes the assessed and the decided submissions to
    the shared folder once (as Parquet), so the duplicate check and the two
    outputs do not re-run validation and lookups.
    """
    spark = candidates.sparkSession
    a = assess(candidates, dim_customers, dim_products, seq, now)
    n = candidates.count() if checkpoint else 0
    if checkpoint:
        with sized(spark, n):
            a = landed(a, "assessed")
    if callable(existing_ids):
        existing_ids = existing_ids(a.where(F.size("_reject") == 0).select("order_id"))
        if checkpoint:  # counted and joined: found once
            with sized(spark, n):
                existing_ids = landed(existing_ids.select("order_id"), "taken")
    d = decide(a, existing_ids, **skew)
    if checkpoint:
        with sized(spark, max(n, existing_ids.count())):
            d = landed(d, "decided")
    m = order_measures(F.col("quantity"), F.col("unit_price"), F.col("_cost"), F.col("order_date"))
    accepted = d.where(F.size("_reject") == 0).select(
        *[F.col(c) for c in REGISTERED_COLS[:8]], *[m[k].alias(k) for k in REGISTERED_COLS[8:]]
    )
    rejected = d.where(F.size("_reject") > 0).select("seq", "order_id", F.explode("_reject").alias("e")).select(
        "seq", "order_id", "e.field", "e.code"
    ).select(*REJECTED_COLS)
    return accepted, rejected


def order_count(new_orders: DataFrame) -> DataFrame:
    """Number of accepted orders (the listing's header figure)."""
    return new_orders.agg(F.count(F.lit(1)).cast("bigint").alias("orders"))


def order_listing(new_orders: DataFrame) -> DataFrame:
    """Accepted orders newest first, with the line total and a display time."""
    return new_orders.select(
        "order_id",
        "customer_id",
        "sku",
        "quantity",
        "unit_price",
        F.format_string("%.2f", F.col("unit_price")).alias("unit_price_text"),
        revenue(F.col("quantity"), F.col("unit_price")).alias("line_total"),
        "order_date",
        "channel",
        F.coalesce(F.date_format("created_at", "yyyy-MM-dd HH:mm"), F.lit("")).alias("registered_at"),
        "created_at",
    ).orderBy(F.desc_nulls_first("created_at"), F.asc("order_id"))
