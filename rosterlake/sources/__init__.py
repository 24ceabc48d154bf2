"""Tables: declared schemas, loading, snapshot writes, adapter for the benchmark data."""
