"""Training-data operators: thirteen corpus operators over text tables.

Nothing else in the library imports this subpackage. Queries and their SQL are in ``queries``.
"""
