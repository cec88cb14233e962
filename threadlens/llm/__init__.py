"""Operators of a training-data pipeline over the driver's document tables.

One module per operator; ``common`` holds hashing, chunking and stage-table
helpers, ``queries`` registers them. Nothing else in the library imports
this subpackage.
"""
