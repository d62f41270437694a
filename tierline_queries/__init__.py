"""Test-side code: raw frames mapped from the driver tables, queries and oracles."""
