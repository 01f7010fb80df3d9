"""Operators for training-data pipelines: one module per operator, ``queries``
and ``oracle`` for the registered queries. Nothing else in the library imports
this package."""
