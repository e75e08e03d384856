"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from importlens.functions.columns import (  # noqa: F401
    commodity_label_key,
    decimals_to_double,
    lenient_number,
    mean,
    month_start_from_period,
    pct_change,
    strict_number,
    strip_ws,
    zfill,
)
