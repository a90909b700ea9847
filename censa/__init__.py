"""Public-health microdata jobs on Spark: scan, clean, convert, load, profile and report."""
