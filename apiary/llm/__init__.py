"""Training-data operators over document and vector tables.

Nothing else in the library imports this package. Each module holds one
operator; ``queries.py`` holds the registered queries and their SQL.
"""
