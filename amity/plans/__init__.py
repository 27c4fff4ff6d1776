"""Whole questions, over DataFrames (`questions`) and over files (`programs`)."""
