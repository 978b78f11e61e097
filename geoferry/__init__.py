"""Moving map layers and tables in and out of a catalog with Spark."""

from geoferry.operators.batches import batch_keys, batch_subset, pending_batches
from geoferry.operators.chunks import assign_chunks, chunk_manifest
from geoferry.operators.conform import conform_schema, stringify_columns
from geoferry.operators.logs import batch_log_rows, ingest_log_rows
from geoferry.operators.registry import enumerate_layers, find_service, service_layers, services_to_create
from geoferry.operators.spatial import geometry_as_wkt, reproject, spatial_reference_info
from geoferry.operators.upsert import current_state, upsert
from geoferry.plans.export import batch_export, batch_log, read_export
from geoferry.plans.ingest import ingest_log, layer_ingest
from geoferry.plans.services import ensure_layers, find_layers, read_registry
from geoferry.sources.chunked import chunked_write, read_chunked
from geoferry.sources.layers import layer_read
from geoferry.sources.tables import append, overwrite_merge_schema

__all__ = [
    "append",
    "assign_chunks",
    "batch_export",
    "batch_keys",
    "batch_log",
    "batch_log_rows",
    "batch_subset",
    "chunk_manifest",
    "chunked_write",
    "conform_schema",
    "current_state",
    "ensure_layers",
    "enumerate_layers",
    "find_layers",
    "find_service",
    "geometry_as_wkt",
    "ingest_log",
    "ingest_log_rows",
    "layer_ingest",
    "layer_read",
    "overwrite_merge_schema",
    "pending_batches",
    "read_chunked",
    "read_export",
    "read_registry",
    "reproject",
    "service_layers",
    "services_to_create",
    "spatial_reference_info",
    "stringify_columns",
    "upsert",
]
