"""Spark-native retail warehouse and decision analytics.

Every operator takes and returns Spark DataFrames; Catalyst plans them and AQE
adapts them at run time.  See README.md for the map of the package.
"""
