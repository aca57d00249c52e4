"""Landing files: fetching, manifest, inventory and reading."""

from tripline.sources.fetch import (
    append_manifest,
    failed_files,
    ingest_landing,
    land_files,
    landing_files,
    manifest_latest,
    read_manifest,
)
from tripline.sources.landing import (
    cast_losses,
    landed_parts,
    landing_inventory,
    landing_types,
    missing_landing_columns,
    missing_months,
    read_landing,
    read_month,
    schema_drift,
)
from tripline.sources.relay import relay_files

__all__ = [
    "append_manifest",
    "cast_losses",
    "failed_files",
    "ingest_landing",
    "land_files",
    "landed_parts",
    "landing_files",
    "landing_inventory",
    "landing_types",
    "manifest_latest",
    "missing_landing_columns",
    "missing_months",
    "read_landing",
    "read_manifest",
    "read_month",
    "relay_files",
    "schema_drift",
]
