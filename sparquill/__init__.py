"""Sparquill: transactions, vectors, text and boxes as plain functions on Spark DataFrames."""

__version__ = "0.1.0"
