"""Operators on DataFrames: extract, profile, fused metrics, modes, samples."""
