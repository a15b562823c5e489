"""Operators for large text corpora: ten named methods, each a function from DataFrame to DataFrame."""
