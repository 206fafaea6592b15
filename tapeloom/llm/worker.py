"""What a Python worker remembers from task to task, of one operator at a time.

Spark hands its workers from stage to stage. Without this, a worker would hold the word lists of every
operator it has served, and each stage of a pipeline would start from the memory of those before it.
"""

import ctypes
import gc

import pyarrow as pa

_HELD = {}  # operator -> what it remembers
_LAST = []  # the operator that began last


def held(name):
    """The dictionary in which operator ``name`` remembers things; it is emptied when another begins."""
    return _HELD.setdefault(name, {})


def begins(name):
    """To be called where a task of ``name`` starts: forgets what another left, and gives its memory back."""
    if _LAST == [name]:
        return
    _LAST[:] = [name]
    for other, memory in _HELD.items():
        if other != name:
            memory.clear()
    gc.collect()  # a word list and its tokenizer refer to each other
    rests()


def rests():
    """Give memory that is no longer used back to the system, where that can be asked for."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # not glibc
