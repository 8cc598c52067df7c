"""Every operator as a query over the star tables, and the SQL that states its result."""

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
