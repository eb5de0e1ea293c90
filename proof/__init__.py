"""Proof queries: each operator on the sample tables next to an independent SQL statement for the same rows."""
