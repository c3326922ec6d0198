"""Outputs and lifecycle of streaming queries."""
