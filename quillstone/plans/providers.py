"""Calls to outside services: retries, a circuit breaker over two providers, usage; nothing here is called in tests or queries."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

# Parts of error messages by which a prompt that is too long is told.
CONTEXT_ERRORS = ("context length", "context_length", "maximum context", "too many tokens", "context window", "prompt is too long", "exceeds the model", "reduce the length")


class RetriesExhausted(Exception):
    def __init__(self, attempts: int, last: Exception):
        super().__init__(f"failed after {attempts} attempts: {last}")
        self.attempts, self.last = attempts, last


def with_retries(call: Callable, attempts: int = 3, wait: float = 2.0, never: tuple = (), sleep: Callable[[float], None] = time.sleep):
    """call(), again after rising waits; exceptions in `never` are passed on at once."""
    for k in range(1, attempts + 1):
        try:
            return call()
        except never:
            raise
        except Exception as e:  # noqa: BLE001
            if k == attempts:
                raise RetriesExhausted(attempts, e) from e
            sleep(wait * k)


def is_context_error(error: Exception | str) -> bool:
    return any(part in str(error).lower() for part in CONTEXT_ERRORS)


@dataclass
class Breaker:
    """Two providers: after `trips` failures in a row the first is left alone and probed again after waits that double."""

    primary: Callable[[str], str]
    fallback: Callable[[str], str] | None = None
    trips: int = 2
    first_wait: float = 60.0
    longest_wait: float = 900.0
    clock: Callable[[], float] = time.monotonic
    failures: int = 0
    open_until: float = 0.0
    wait: float = 0.0
    calls: dict[str, int] = field(default_factory=lambda: {"primary": 0, "fallback": 0})

    def current(self) -> str:
        return "fallback" if self.fallback and self.clock() < self.open_until else "primary"

    def call(self, prompt: str) -> str:
        if self.current() == "primary":
            try:
                out = self.primary(prompt)
                self.failures, self.wait, self.open_until = 0, 0.0, 0.0
                self.calls["primary"] += 1
                return out
            except Exception as e:  # noqa: BLE001
                if is_context_error(e):
                    raise
                self.failures += 1
                if self.failures >= self.trips or self.wait:
                    self.wait = min(max(self.wait * 2, self.first_wait), self.longest_wait)
                    self.open_until = self.clock() + self.wait
                if not self.fallback:
                    raise
        out = self.fallback(prompt)
        self.calls["fallback"] += 1
        return out
