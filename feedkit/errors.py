"""Errors raised while a plan is built. Errors found inside running plans use Spark's own ``raise_error``."""

from __future__ import annotations


class FeedkitError(Exception):
    """Base of all errors of this package."""


class SnapshotMissing(FeedkitError):
    """No feed snapshot lies inside the look-back window."""


class EmptyInput(FeedkitError):
    """An operator that needs rows was given none."""


class TooFewRows(FeedkitError):
    """Fewer rows than the operator was asked to work with."""


class FolderMissing(FeedkitError):
    """The folder to write into does not exist."""


class UnhandledName(FeedkitError):
    """A name that no list knows."""


class MissingLinks(FeedkitError):
    """Rows point at parents that do not exist."""


class SharedDirUnset(FeedkitError):
    """A cluster session names no shared folder in ``spark.checkpoint.dir``."""


class RowsMoved(FeedkitError):
    """A change of some parts of a table gave rows of other parts."""
