"""Readers and writers: delimited lines, market data, tables, logs."""
