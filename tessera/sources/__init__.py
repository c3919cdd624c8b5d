"""Storage: manifests, tables, the catalog."""
