"""Operators of a training-data pipeline over ``documents``, ``pages``, ``benchmark`` and ``labels``.

Nothing else in the library imports this subpackage. ``registry`` lists its queries.
"""
