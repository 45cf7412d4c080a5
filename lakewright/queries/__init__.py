"""Example queries over the test tables, each with the SQL that checks it.

A derivation is SQL both engines read the same way; it shapes the given tables into the
inputs the operators expect (logs, dictionaries, raw text). The operator then runs in Spark
and the check states the same result in SQL.
"""
