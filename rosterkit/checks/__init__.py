"""Check queries on the driver tables and their SQL oracles."""
