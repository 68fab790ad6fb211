"""Scans: wide day files, CSV, tables over JDBC, message topics."""
