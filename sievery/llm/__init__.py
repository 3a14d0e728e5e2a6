"""Operators for building language-model training data.

Each module holds one operator with its own general interface; ``queries``
holds the registered queries over the supplied tables.  Nothing else in the
library imports this subpackage.
"""
