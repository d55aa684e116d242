"""Array expressions and NumPy kernels on spectra."""
