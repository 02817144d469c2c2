"""File sources and the catalog's own tables."""
