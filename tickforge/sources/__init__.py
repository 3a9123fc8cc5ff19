"""Sources and sinks: landed vendor pages, partitioned tables, and the
inputs derived from the driver's test tables."""
