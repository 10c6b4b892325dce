"""Written tables are queryable through spark.sql via temp views."""
from parity import SF_SMALL

from ordermart.plans import catalog
from ordermart.session import scale_settings


def test_views_answer_sql(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    names = wh.register_views(prefix="t_")
    assert "t_v_orders_full" in names
    n = spark.sql("SELECT COUNT(*) AS n FROM t_v_orders_full").first()["n"]
    assert n == 4187
    months = spark.sql("SELECT year_month, SUM(revenue) AS r FROM t_fact_orders GROUP BY year_month").count()
    assert months == 83


def test_scale_settings():
    s = scale_settings(100 * (1 << 40))
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(1)["spark.sql.shuffle.partitions"] == "8"


def test_publish_external_tables(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS om_test")
    names = wh.publish("om_test")
    assert "om_test.fact_orders" in names
    assert spark.table("om_test.fact_orders").count() == 4271
    assert spark.sql("SELECT COUNT(DISTINCT year_month) AS m FROM om_test.fact_orders").first()["m"] == 83
