"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  Every operator module exposes a
function from DataFrame to DataFrame; ``queries`` holds the thin registered
queries and their SQL.
"""
