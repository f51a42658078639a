"""Plans of the amplicon engine."""
