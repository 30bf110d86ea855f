"""Errors raised before any output is written."""


class StationLakeError(Exception):
    """Base class."""


class MissingInputError(StationLakeError):
    """No input files were found where some are required."""


class RawFileRejected(StationLakeError):
    """At least one landed file failed validation."""


class KeyViolation(StationLakeError):
    """A key column is NULL, or a key occurs more than once."""


class MissingColumnError(StationLakeError):
    """A measured column is absent from the input."""


class QualityGateFailed(StationLakeError):
    """At least one expectation failed."""


class BadRequestedYears(StationLakeError, ValueError):
    """The list of requested years is not acceptable."""
