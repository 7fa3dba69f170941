"""stellate: entity reconciliation and star-schema building on Spark.

Sub-packages:

* ``functions`` – column expressions (cleaning, parsing, text, geometry text)
* ``operators`` – DataFrame -> DataFrame building blocks (dedupe, reconcile,
  dense ids, joins, similarity, dissolve, ...)
* ``sources`` / ``sinks`` – readers and writers (CSV, Parquet, XLSX,
  shapefile, GeoJSON, KML, snapshots, partitioned Parquet)
* ``plans`` – the composite pipelines (star schema, silver tables, serving)
  and their bindings to the benchmark tables
* ``streaming`` – incremental ingestion of landed snapshots
"""

from stellate.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
