"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Each module holds one operator with its own interface; ``queries`` applies them to the test tables.
All of them select the columns they need before anything else, so extra columns, whatever their
names, neither clash nor travel through a shuffle.
"""
