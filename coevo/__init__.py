"""Sequence co-evolution analytics on Spark."""
