"""Operators for preparing training text at scale, and their registered queries.

Nothing else in the library imports this subpackage.
"""

from terralode.llm.queries import registered

__all__ = ["registered"]
