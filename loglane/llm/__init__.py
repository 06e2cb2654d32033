"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. ``queries.REGISTRY``
holds the registered queries ``op1_...`` to ``op13_...``; the top-level module
``corpus_pipeline`` chains five of the operators.
"""
