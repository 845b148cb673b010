"""Operators of a training-data pipeline; nothing else in the library imports them.

Each module holds one operator with its own general interface; ``queries``
registers one ``opN_<name>`` query per operator over the driver's tables.
"""
