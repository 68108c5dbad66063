"""Jobs that follow a growing set of releases."""
