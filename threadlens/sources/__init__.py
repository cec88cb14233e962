"""Sources: driver tables, fixture views, landed CSV/JSON files."""
