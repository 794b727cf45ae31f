"""Exceptions raised by the gates of a load."""


class DataQualityError(Exception):
    """One or more data-quality checks failed; the message lists all of them."""


class SchemaDriftError(Exception):
    """The incoming schema differs from the stored one and the run was not forced."""


class SourceError(ValueError):
    """A source spec cannot be read (unknown type, missing key column, ...)."""
