"""Queries over the driver's tables and the DuckDB SQL they are compared with."""
