"""Sources and sinks: Parquet directory loader, schema report, result writer, published results."""

from odflow.sources.parquet import list_parquet_files, load_trips, schema_report, write_result
from odflow.sources.published import publish_result, read_manifest, read_result, retire_versions

__all__ = ["list_parquet_files", "load_trips", "publish_result", "read_manifest", "read_result", "retire_versions",
           "schema_report", "write_result"]
