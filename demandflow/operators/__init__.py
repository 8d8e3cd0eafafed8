"""Relational operators over observation DataFrames."""
