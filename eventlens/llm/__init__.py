"""Operators for building language-model training data at corpus scale.

Every operator is a function over Spark DataFrames; ``catalog`` registers one
query per operator and the SQL that checks it where SQL can express it.
"""
