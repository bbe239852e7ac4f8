"""Named queries with their DuckDB oracles (catalog, *_queries), the inventory
map, and the two runnable jobs (sensor_chain, bars_chain)."""
