"""Sources and sinks: driver tables, derived encounter views, files, result tables."""
