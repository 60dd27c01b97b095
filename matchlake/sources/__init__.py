"""Sources (readers) and sinks (writers)."""

from .commits import CommitLog
from .readers import (CORRUPT, OPEN_FIELDS, explode_envelope, field_drift, ids_from_paths, list_stored_ids, map_to_rows, maps_callouts,
                      read_documents, unknown_fields)
from .sinks import (append, as_view, drop_old_contents, error_log, land_json, overwrite_partitions, read_replaced, replace,
                    snapshot)

__all__ = [
    "CORRUPT", "OPEN_FIELDS", "CommitLog", "explode_envelope", "field_drift", "ids_from_paths", "list_stored_ids", "map_to_rows", "maps_callouts",
    "read_documents", "unknown_fields", "append", "as_view", "error_log", "land_json", "overwrite_partitions",
    "drop_old_contents", "read_replaced", "replace", "snapshot",
]
