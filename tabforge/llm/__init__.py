"""Operators of a training-data pipeline over a corpus of documents and pages.

Each module holds one operator; ``queries.py`` registers them for the driver.
Nothing else in the package imports this subpackage.
"""
