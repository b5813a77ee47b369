"""Schemas, tables, reference data and input feeds."""
