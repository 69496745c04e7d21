"""Sources and sinks: landed payloads, bronze/silver lake folders, tables,
and (key, value) message streams.  Every function takes a root URI, so the
same code runs on a local folder or an object store."""
