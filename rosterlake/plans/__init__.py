"""Report plans: one function per catalogued query, from tables to a lazy DataFrame."""
