"""Sources and sinks: test-table feeds, seed CSVs, quote landing files, table writes."""
