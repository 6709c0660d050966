"""Sources and sinks: file readers, table writers, catalog, test-data adapter."""
