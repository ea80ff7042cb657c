"""Sources and sinks: driver tables, raw station files, listings."""
