"""Objects that a Python worker keeps from one task to the next."""

from __future__ import annotations


def kept(name: str, key, make):
    """The object of this worker process called ``name``; made anew if its key is another one.

    Functions of this folder travel by value, so their globals are new in each
    task; a module of the process is not. One object per name is kept.
    """
    import sys
    import types

    state = sys.modules.setdefault("waybill_worker", types.ModuleType("waybill_worker"))
    if getattr(state, name, (None,))[0] != key:
        setattr(state, name, None)  # the old one goes before the new one is made
        setattr(state, name, (key, make()))
    return getattr(state, name)[1]
