"""Amplicon-abundance analytics as PySpark DataFrame transformations."""
