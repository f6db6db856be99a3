"""Compositions of operators, and the queries offered to the driver."""
