"""revlens: review and catalog analytics as Spark DataFrame plans.

Subpackages
-----------
sources     test-table views, CSV reader, typed catalog parse, result sinks
functions   Column -> Column parsing and vector functions (no Python UDFs)
operators   profiling, exact quantiles, key-set joins, top-k, hash splits
plans       the user-level jobs (reviewers, catalog, products, features,
            models, reports) and the query registry
streaming   empty: the workload has no streaming part
"""
