"""Sources of the amplicon engine."""
