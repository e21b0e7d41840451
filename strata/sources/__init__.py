"""Scans and table IO: JDBC, CSV, the layered table store, watermarks,
and the bronze-shaped views over the driver's TPC-H-like tables."""
