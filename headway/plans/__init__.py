"""Jobs: operators wired to sources, tables and runs."""
