"""Column-to-column functions; every one stays inside Catalyst expressions."""
