"""Operators of a large-scale training-data pipeline (one module each).

Nothing outside this subpackage imports it; general helpers come from
``scoria.session``.  ``catalog.py`` holds the registered queries.
"""
