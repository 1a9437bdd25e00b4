"""Sources and sinks: journals, files, generations, outbox records and snapshots."""
