"""Exceptions raised while a plan is built or a check is enforced."""


class StationLoomError(Exception):
    """Base of all errors of this package."""


class ConfigurationError(StationLoomError):
    """A rule file or a session setting is missing or malformed."""


class ValidationError(StationLoomError):
    """An argument or a table does not meet its contract."""


class DataIntegrityError(StationLoomError):
    """A check asked to be strict found bad data."""


class DataProcessingError(StationLoomError):
    """A step cannot produce a result from its input."""


class DataParsingError(StationLoomError):
    """A text source does not have the expected layout."""
