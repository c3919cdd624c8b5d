"""Change data of tables, and windowed streams over files."""
