"""Models that live as long as their Python worker.

The cache is a module of its own because functions sent to the workers carry
copies of the globals of ``__main__`` and of closures, but import modules.
"""

from __future__ import annotations

from collections.abc import Callable

_MODELS: dict[str, object] = {}


def model(key: str, factory: Callable[[], object]) -> object:
    """The worker's model for ``key`` (unique to one factory), built once."""
    if key not in _MODELS:
        _MODELS[key] = factory()
    return _MODELS[key]
