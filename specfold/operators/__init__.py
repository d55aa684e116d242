"""Operators on tables of spectra."""
