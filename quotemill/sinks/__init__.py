"""Writers: append, keyed upsert, load audit, snapshot files."""
