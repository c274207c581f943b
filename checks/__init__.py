"""Inputs, queries and reference SQL for checking the operators against DuckDB."""
