"""What tasks share: files in the shared folder, and their worker's memory.

Every attempt of a task writes under a name of its own; the names that count are
the rows of the table that Spark commits, so attempts that were lost or repeated
leave files that nothing reads.
"""

from __future__ import annotations

import sys
import types
import uuid

import pyarrow as pa
import pyarrow.fs as pafs


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file, by URI or absolute path."""
    return pafs.FileSystem.from_uri(uri)


def new_file(folder: str, part: int, suffix: str):
    """Stream and URI of a new file in ``folder``."""
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    name = f"part-{part:05d}-{uuid.uuid4().hex}{suffix}"
    return system.open_output_stream(f"{path}/{name}", compression=None), f"{folder.rstrip('/')}/{name}"


def open_file(uri: str):
    system, path = open_fs(uri)
    return system.open_input_file(path)


def worker_state(owner: str) -> dict:
    """What an operator keeps as long as the worker process lives: a worker is used again
    for later stages, and what another operator kept there goes first. Functions of this
    package travel with each task by value, so their own module's variables last for a
    task only."""
    name = "_offerscope_worker_state"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if owner not in held:
        for other in [key for key in held if not key.startswith("__")]:
            del held[other]
        pa.default_memory_pool().release_unused()  # or pages that earlier batches took stay with the worker
        held[owner] = {}
    return held[owner]
