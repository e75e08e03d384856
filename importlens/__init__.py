"""importlens — trade-demand analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a small family of
them) that only builds a Catalyst plan; nothing is collected to the driver.

Modules:

* ``importlens.operators.harmonize`` / ``clean``: landed files -> typed tables
* ``importlens.operators.measures`` / ``forecast``: the published analyses
* ``importlens.operators.report`` / ``coverage``: dashboard data sets, pull coverage
* ``importlens.sources`` / ``importlens.sinks``: CSV, Parquet, JSON payloads, JDBC
* ``importlens.plans.jobs``: the end-to-end job (also ``python -m importlens``)
* ``importlens.plans.catalog``: every query with its SQL oracle (``__spark_entry__``)
* ``importlens.streaming.ingest``: incremental cleaning of newly landed files
"""

__version__ = "0.1.0"
