"""Reading the source tables, the two composed views, and writing results."""
