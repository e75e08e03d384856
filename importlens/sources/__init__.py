"""Readers for landed inputs (CSV, JSON payload text, JDBC, tagged folders)."""
