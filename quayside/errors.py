"""Errors raised when an input or a stored table is refused."""


class QuaysideError(RuntimeError):
    """Base class for every refusal in this package."""


class PageError(QuaysideError):
    """Landed pages overlap, do not add up, or are not shaped like an API response."""


class StagingError(QuaysideError):
    """Staged pages are missing, incomplete or do not match their recorded hashes."""


class SilverIntegrityError(QuaysideError):
    """Typed observations lost values during construction."""


class MixedSourceError(QuaysideError):
    """Observations from a second source would enter a single-source computation."""


class ShapeOriginMismatch(QuaysideError):
    """Shape parameters estimated from one source were offered for another source."""


class ShapeEstimationError(QuaysideError):
    """The seasonal shape cannot be estimated from these observations."""


class PublishConflict(QuaysideError):
    """The published version moved since this run started."""


class IntegrityError(QuaysideError):
    """A stored table does not match what its manifest records."""


class StagingValidationError(QuaysideError):
    """A staged table has the wrong number of rows or repeats a key."""


class DatasetConflict(QuaysideError):
    """A version is already imported with different content, or history disagrees."""


class OutOfOrderImport(QuaysideError):
    """A version was offered before its predecessor was imported."""


class LoadRefused(QuaysideError):
    """A check failed before a load began; nothing was loaded."""


class LoadMismatch(QuaysideError):
    """What was read back after a load is not what was verified."""


class UnknownVersion(QuaysideError):
    """A dataset version was asked for that was never imported."""


class RuleError(QuaysideError):
    """An alert rule names an unknown curve or position, or has an invalid threshold."""


class AppendOnlyError(QuaysideError):
    """An append-only table was asked to hold a second, different set of rows for a version."""


class ConfigError(QuaysideError):
    """The session lacks a setting that a cluster needs."""
