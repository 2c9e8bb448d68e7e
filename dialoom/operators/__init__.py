"""Stages: take DataFrames, return DataFrames."""
