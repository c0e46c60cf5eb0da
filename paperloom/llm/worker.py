"""What a Python worker keeps from task to task."""

from __future__ import annotations

import sys
from collections.abc import Callable


def kept(name: str, make: Callable[[], object]) -> object:
    """The object of this name in this process, made on first use.

    Functions of this package travel with their tasks, and bring their module's variables
    anew each time, so what must outlive a task lies outside of them.
    """
    known = vars(sys).setdefault("_paperloom_kept", {})
    if name not in known:
        known[name] = make()
    return known[name]
