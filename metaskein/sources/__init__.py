"""Readers for catalog tables and documents, snapshot storage, and sinks."""
