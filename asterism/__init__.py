"""Dimensional warehouse and data-quality operators on the PySpark DataFrame API."""
