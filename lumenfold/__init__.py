"""Corpus counting, sampling, panel preparation, mass regression and similarity on Spark DataFrames.

Every public function takes DataFrames (or Columns) and returns a DataFrame (or
Column), so that a caller composes them with ordinary Spark code.
"""
