"""Listings quality, view dynamics and text-corpus operators on Spark DataFrames."""
