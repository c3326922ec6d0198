"""Inputs as DataFrames."""
