"""Errors of the library."""


class StrataError(Exception):
    """Base of all errors raised here."""


class InvalidRequestError(StrataError, ValueError):
    """An argument is wrong; param names it."""

    def __init__(self, message: str, param: str | None = None) -> None:
        super().__init__(message)
        self.param = param


class NotReadyError(StrataError):
    """A model was used before it was fitted, or after it was closed."""
