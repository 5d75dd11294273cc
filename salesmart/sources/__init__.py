"""Sources and sinks: files, warehouse layout, raw dataset writer, test-data adapter."""
