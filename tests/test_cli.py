"""The command line runs the batch from CSV files and prints the reports."""
from ordermart import cli

ORDERS = "order_id,customer_id,sku,quantity,unit_price,order_date,channel\nO1,C1,S1,2,10.00,2024-01-05,Retail\n" \
         "O2,C1,S1,1,5,2024-02-06,export\n"
CUSTOMERS = "customer_id,name,country,segment,created_at\nC1,Ana,Ecuador,Retail,2023-01-01\n"
PRODUCTS = "sku,category,cost,active\nS1,Luxury,4.00,True\n"


def test_cli_run_and_kpis(spark, tmp_path, capsys):
    for name, text in (("orders.csv", ORDERS), ("customers.csv", CUSTOMERS), ("products.csv", PRODUCTS)):
        (tmp_path / name).write_text(text)
    out = str(tmp_path / "wh")
    cli.main(["run", "--orders", str(tmp_path / "orders.csv"), "--customers", str(tmp_path / "customers.csv"),
              "--products", str(tmp_path / "products.csv"), "--out", out])
    cli.main(["kpis", "--warehouse", out])
    text = capsys.readouterr().out
    assert "QA summary" in text and "sales_by_month" in text and "2024-02" in text and "25.00" in text
