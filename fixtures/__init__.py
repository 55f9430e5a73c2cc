"""Test inputs derived from the TPC-H-like tables, in Spark and in DuckDB SQL."""
