"""Sources and sinks: relational and CSV readers, the driver-data crosswalk, writers, the load gate."""
