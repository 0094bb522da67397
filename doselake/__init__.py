"""Vaccination-dose analytics on PySpark: clean, lay out, roll up, query, generate."""

from doselake.schema import CANONICAL, FACT_SCHEMA, MONTH

__all__ = ["CANONICAL", "FACT_SCHEMA", "MONTH"]
__version__ = "0.1.0"
