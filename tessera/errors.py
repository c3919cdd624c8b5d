"""Errors that the engine raises."""


class TesseraError(Exception):
    """Base of all errors here."""


class NoSuchTable(TesseraError):
    pass


class TableAlreadyExists(TesseraError):
    pass


class NoSuchNamespace(TesseraError):
    pass


class NamespaceAlreadyExists(TesseraError):
    pass


class NamespaceNotEmpty(TesseraError):
    pass


class NoSuchVersion(TesseraError, ValueError):
    pass


class CommitConflict(TesseraError):
    """Another commit touched the same fragments since this one's snapshot was read."""


class InvalidArgument(TesseraError, ValueError):
    pass


class Unsupported(TesseraError, NotImplementedError):
    pass


class ParseError(TesseraError, ValueError):
    pass
