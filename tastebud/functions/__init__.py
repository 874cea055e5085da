"""Column expressions used by the operators (all built-in Spark functions)."""

from . import routes, similarity  # noqa: F401
