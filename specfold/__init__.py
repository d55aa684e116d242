"""Spectral-line tables as Spark DataFrames: filters, links, array kernels, statistics, decomposition, gridding and cubes."""
