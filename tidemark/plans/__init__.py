"""Warehouse loads, revenue reports, and the queries over the test tables."""
