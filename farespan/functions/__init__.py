"""Column-level helpers: dates, keys, bands, labels and fixed values."""
