"""Named queries over the general-purpose tables and their SQL twins."""

from deskstar.catalogue import checks, jobs, lake, relational, scalars  # noqa: F401  (fill the registry)
from deskstar.catalogue.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
