"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Every operator takes a DataFrame with at least ``doc_id`` (bigint) and ``text`` (string), reads no other
column unless its docstring says so, and treats a null text as empty. Extra columns may have any name.
"""
