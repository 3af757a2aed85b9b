"""Tabular and text analytics expressed as Spark DataFrame plans."""
