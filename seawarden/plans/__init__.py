"""Operators chained into layers, reports and the query registry."""
