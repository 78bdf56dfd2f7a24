"""The engine's log, and the redaction of values in it."""

from __future__ import annotations

import logging
import re

log = logging.getLogger("sluice")
_VALUE = re.compile(r"'(?:[^'\\]|''|\\.)*'|\"(?:[^\"\\]|\\.)*\"|\b\d[\d.]*\b")


class Redact(logging.Filter):
    """Quoted strings and numbers in messages become ?."""

    def filter(self, record: logging.LogRecord) -> bool:
        record.msg, record.args = _VALUE.sub("?", record.getMessage()), ()
        return True


def redact(on: bool) -> None:
    for f in [f for f in log.filters if isinstance(f, Redact)]:
        log.removeFilter(f)
    if on:
        log.addFilter(Redact())


def retried(work, times: int = 3, fatal: tuple = (ValueError, TypeError, KeyError)):  # noqa: ANN001, ANN201
    """work(), again after errors that may pass (the file system's, the network's), at once after others."""
    for left in range(times - 1, -1, -1):
        try:
            return work()
        except fatal:
            raise
        except Exception as e:  # noqa: BLE001
            if not left:
                raise
            log.warning("again after %s", e)
