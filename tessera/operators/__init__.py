"""Row-level changes, column evolution, maintenance, indexes, vector search, joins."""
