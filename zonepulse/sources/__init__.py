from zonepulse.sources.adapters import (
    RAW_COLUMNS,
    next_event_time,
    trips_from_events,
    trips_from_lineitem,
    unique_zones,
    zones_from_suppliers,
)
from zonepulse.sources.sinks import bronze_clone, readback_check, write_and_check, write_table
from zonepulse.sources.tables import TEST_TABLES, read_table, scan, table_location

__all__ = [
    "RAW_COLUMNS",
    "next_event_time",
    "trips_from_events",
    "trips_from_lineitem",
    "unique_zones",
    "zones_from_suppliers",
    "bronze_clone",
    "readback_check",
    "write_and_check",
    "write_table",
    "TEST_TABLES",
    "read_table",
    "scan",
    "table_location",
]
