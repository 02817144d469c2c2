"""foliar: leaf-spectra and leaf-trait catalogs built with Spark DataFrames."""

__version__ = "0.1.0"
