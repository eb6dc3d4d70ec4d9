"""Spark-native analytics for sensor counts: cleaning, calendars, islands, slices, scoring, networks and streams."""
