"""The built star, read through SQL views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from duka.session import ensure_checkpoint_dir
from duka.sources.catalog import register_reports, register_tables
from duka.sources.warehouse import Warehouse


def star_row_counts(w: Warehouse) -> DataFrame:
    """Rows of every table and of one report after a full reload of the star,
    as SQL over its views counts them."""
    from duka.sources.store import StoredWarehouse, build_warehouse
    out = f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/star-{uuid.uuid4().hex}"
    build_warehouse(w, out)
    build_warehouse(w, out)     # the reload replaces, it does not add
    star = StoredWarehouse(w.spark, out, w.sf_dir, **w.params)
    names = register_tables(star, "star_") + register_reports(star, ["revenue_kpis"], "star_")
    return w.spark.sql(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM star_{n}" for n in names))
