"""Scalar functions as Catalyst column expressions."""
