"""Operators for training-data pipelines over document tables.

One module per operator; ``queries`` registers them for the driver. Nothing
else in the library imports this subpackage.
"""
