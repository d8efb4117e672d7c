"""The report plans, grouped in families that share one pipeline."""
