"""Normalisation of tagged values, as column expressions."""
