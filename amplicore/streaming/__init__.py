"""Streaming of the amplicon engine."""
