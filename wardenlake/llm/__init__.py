"""Operators of a training-data pipeline over ``documents``, ``pages``, ``benchmark`` and ``embeddings``.

Nothing outside this package imports it. ``catalog`` holds the registered queries and their SQL texts.
"""
