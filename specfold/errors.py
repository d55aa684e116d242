"""One hierarchy for what can go wrong."""


class SpecfoldError(Exception):
    """Any error of this library."""


class ConfigError(SpecfoldError):
    """A setting is missing or has no meaning."""


class NoDataError(SpecfoldError):
    """Nothing is left to work on."""


class SchemaError(SpecfoldError):
    """Tables that should agree in columns or grids do not."""


class PairingError(SpecfoldError):
    """A key that must be unique is not."""


class FitsError(SpecfoldError):
    """A file is not what it should be."""
