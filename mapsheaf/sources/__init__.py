"""Reading and writing releases, catalogs, extracts and tile tables."""
