"""Column-level helpers that stay inside Catalyst expressions."""
