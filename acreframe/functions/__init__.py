"""Column functions: safe casts, names and dates, spectral indices, class schemes."""
