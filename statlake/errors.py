"""Errors raised by driver-side checks."""


class LakeError(Exception):
    """Base class of all errors of this library."""


class InvalidPath(LakeError, ValueError):
    """A logical path breaks the path rules."""


class MissingOption(LakeError, ValueError):
    """A write lacks a required option, or an option has a value outside its closed set."""


class DatasetNotFound(LakeError, LookupError):
    """No committed version of the dataset is visible."""


class PermissionDenied(LakeError):
    """No grant covers the requested access."""


class VersionExists(LakeError):
    """The version directory is already there; versions are immutable."""


class PolicyError(LakeError, ValueError):
    """A pseudonymization policy cannot be applied."""


class WriteExpired(LakeError):
    """A write outlived its claim and was not committed."""
