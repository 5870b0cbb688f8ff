"""Query plans: Silver/Gold frames from the driver tables, layered runs, the query registry."""
