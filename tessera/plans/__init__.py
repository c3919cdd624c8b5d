"""Fragment pruning and the SQL front-end."""
