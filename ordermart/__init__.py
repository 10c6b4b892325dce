"""ordermart: sales-order cleaning, star schema and KPI reports on Spark DataFrames.

Entry points: ``ordermart.plans.pipeline`` (``csv_inputs``, ``run_batch``,
``Warehouse``), ``ordermart.operators.kpis`` / ``quality`` (reports),
``ordermart.operators.orders`` (validation and registration) and
``ordermart.streaming.registration`` (the registration stream).
"""

__version__ = "0.1.0"
