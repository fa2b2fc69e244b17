"""Sources and sinks: operational readers, CSV lookups, driver-table mapping."""
