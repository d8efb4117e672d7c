"""DataFrame transforms shared by the report plans."""
