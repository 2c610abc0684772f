"""Waymarks: trajectory analytics for mobile-signalling data, as PySpark DataFrame operators."""
