"""Rules and profiles: what is done to which theme and type."""
