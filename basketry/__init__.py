"""basketry: order analytics on Spark.

Raw order headers and order lines are cleaned into typed DataFrames, each
order is classified by its customer's rolling order history, and order,
order-line and product marts are published. Reports, data-quality checks,
grouped business metrics and daily sales forecasts are built on top.

Model functions take and return lazy DataFrames. Sub-packages:

* ``sources``   – readers, schemas, sinks, the adapter for the test tables
* ``functions`` – Column -> Column helpers (segment rule, calendar, money)
* ``operators`` – reusable relational building blocks (lookback, date spine,
                  generic checks, explore)
* ``plans``     – the models themselves (staging, marts, reports, checks,
                  semantic layer, forecast)
"""

from basketry.config import Config, DRIVER_CONFIG, REFERENCE_CONFIG

__all__ = ["Config", "DRIVER_CONFIG", "REFERENCE_CONFIG"]
