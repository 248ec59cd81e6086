"""The engine's log: JSON lines on standard output, set up once for the whole package."""

from __future__ import annotations

import json
import logging.config
from datetime import UTC, datetime

PACKAGE = __name__.rpartition(".")[0]
#: Fixed keys of a line, and what each takes from a record.
KEYS = {
    "ts": lambda r: datetime.fromtimestamp(r.created, UTC).isoformat(),
    "level": lambda r: r.levelname,
    "module": lambda r: r.name,
    "message": lambda r: r.getMessage(),
    "exc": lambda r: logging.Formatter().formatException(r.exc_info) if r.exc_info else None,
}


class Lines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        found = {key: take(record) for key, take in KEYS.items()}
        return json.dumps({k: v for k, v in found.items() if v is not None})


def configure(level: str = "INFO", stream: str = "ext://sys.stdout") -> None:
    """One handler at the package's own logger; modules log with ``logging.getLogger(__name__)``."""
    logging.config.dictConfig({
        "version": 1,
        "disable_existing_loggers": False,
        "formatters": {"lines": {"()": Lines}},
        "handlers": {"out": {"class": "logging.StreamHandler", "formatter": "lines", "stream": stream}},
        "loggers": {PACKAGE: {"level": level, "handlers": ["out"], "propagate": False}},
    })
