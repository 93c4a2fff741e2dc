"""Layered sales-warehouse operators written with the PySpark DataFrame API."""
