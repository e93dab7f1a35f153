"""Tablemend: curate many small, inconsistently shaped tables into one catalogue with Spark."""
