"""Warehouse operators: DataFrame in, DataFrame out."""
