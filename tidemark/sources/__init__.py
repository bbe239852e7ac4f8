"""Inputs and outputs: the driver tables, fixtures derived from them, the
synthetic reading source and the parquet/JDBC sinks."""
