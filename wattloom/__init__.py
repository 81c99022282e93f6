"""Spark operators and jobs for household energy series, weather and tariffs."""
