"""Writes: tables, decimal-typed results, message topics, JDBC."""
