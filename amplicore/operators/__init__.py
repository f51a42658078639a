"""Operators of the amplicon engine."""
