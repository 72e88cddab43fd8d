"""Table readers and writers, listings, archives and catalogs."""
