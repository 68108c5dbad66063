"""mapsheaf: map-feature releases on Spark."""
