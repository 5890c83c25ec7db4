"""Column functions: text, masses, binning."""
