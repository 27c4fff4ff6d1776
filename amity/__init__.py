"""Friend-graph and review analytics as Spark DataFrame functions.

Sources turn text files into typed DataFrames, operators map DataFrames to
DataFrames without running anything, plans compose them into whole questions
and sinks write the answers.
"""
