"""Sources and sinks: schemas, file readers, fixture views, writers."""

from . import fixtures, readers, schemas  # noqa: F401
