"""Switching the library's log on and off."""

from __future__ import annotations

import logging
import os

LOGGER = logging.getLogger("strataloom")
LOGGER.addHandler(logging.NullHandler())
#: The one handler that writes, added and removed as a whole.
SCREEN = logging.StreamHandler()
SCREEN.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))


def enable_logging(level: int | str = "INFO") -> None:
    """Write the log to standard error from `level` on."""
    LOGGER.setLevel(level)
    LOGGER.addHandler(SCREEN)


def disable_logging() -> None:
    """Write no log."""
    LOGGER.removeHandler(SCREEN)
    LOGGER.setLevel(logging.NOTSET)


if level := os.environ.get("STRATALOOM_LOG"):
    enable_logging(level.upper())
