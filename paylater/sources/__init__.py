"""Sources and sinks: readers, bronze loads and the test-table mapping."""
