"""Operators for training text; nothing outside this folder imports it."""

#: Query modules that the entry file adds.
MODULES = ["voxsieve.llm.queries"]
