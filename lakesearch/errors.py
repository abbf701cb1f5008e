"""Exceptions raised while a query or a schema is being described."""


class LakeSearchError(ValueError):
    """Base class of every error this package raises."""


class SchemaError(LakeSearchError):
    """A schema, a document or a vector does not have the declared shape."""


class QueryError(LakeSearchError):
    """A query argument is outside its allowed range."""
