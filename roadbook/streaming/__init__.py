"""Running the daily job on files as they arrive."""
