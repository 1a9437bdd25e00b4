"""Operations of a training-data pipeline; nothing else in the library imports this subpackage."""

from revtide.llm import queries as _queries  # noqa: F401
from revtide.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
