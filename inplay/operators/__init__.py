"""Operators on dated, labelled event tables. All take and return DataFrames."""
