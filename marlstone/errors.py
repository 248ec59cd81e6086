"""Errors that a caller may want to tell apart."""

from dataclasses import dataclass


class EngineError(Exception):
    """Base of the engine's own errors."""


class StorageError(EngineError):
    """A table or folder could not be read or written."""


@dataclass
class GateError(EngineError):
    """A check before a step refused it."""

    gate: str
    reason: str

    def __str__(self) -> str:
        return f"[{self.gate}] {self.reason}"
