"""Analytics for dated, labelled event tables, as lazy DataFrame, SQL and ML operators."""

__version__ = "0.1.0"
