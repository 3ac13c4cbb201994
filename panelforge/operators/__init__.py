"""Operators: every function maps DataFrame(s) to a DataFrame."""
