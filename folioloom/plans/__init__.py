"""Skew handling and the jobs that chain operators from one table to the next."""
