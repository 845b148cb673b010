"""Sources and sinks: parquet table scans, idempotent overwrite writes, versions and releases of layers."""

from ledgerline.sources.tables import (materialize, read_table, replace_partitions,
                                       write_table)
from ledgerline.sources.versions import Conflict, Version, VersionStore, fingerprint_of

__all__ = ["read_table", "write_table", "replace_partitions", "materialize", "Conflict", "Version", "VersionStore", "fingerprint_of"]
