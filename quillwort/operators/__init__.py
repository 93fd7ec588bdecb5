"""Relational and text operators, each a function of DataFrames or Columns."""
