"""Column-level building blocks: calendar, geometry, geohash and cell identifiers."""
