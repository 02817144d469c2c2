"""One module per project: raw tables in, catalog rows out."""
