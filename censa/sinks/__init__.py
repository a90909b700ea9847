"""Where results go: tables, partitioned folders, CSV and JSON files."""
