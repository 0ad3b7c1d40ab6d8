"""salesmart: multi-source sales integration, star schema and basket analytics on Spark.

Every public function takes and returns DataFrames (or Columns); nothing
holds a global session. Sub-packages:

* ``sources``   - typed readers for the five source shapes, the FX feed,
                  bulk sheets, and the adapter that derives them from the
                  given test tables.
* ``functions`` - Column -> Column cleaning and validation expressions.
* ``operators`` - equivalence, merge, staging, warehouse, FX, quality,
                  baskets, rules, recommendation, KPI, listing, orders, bulk.
* ``plans``     - composed jobs (whole ETL run, query registry, oracle SQL).
* ``streaming`` - Structured Streaming re-aims of the incremental load.
"""

__version__ = "0.1.0"
