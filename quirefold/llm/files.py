"""Binary files in the shared folder, written and read by tasks.

A task writes under a name that no other attempt uses and reports it in its rows; only files that
a finished task reported are ever read, so a lost or repeated task leaves nothing wrong behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


@contextmanager
def new_file(folder: str, suffix: str) -> Iterator[tuple[str, object]]:
    """(path, writable stream) of a new file; the folder is a path or a URI."""
    where, base = fs.FileSystem.from_uri(folder)
    where.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with where.open_output_stream(f"{base}/{name}") as out:
        yield f"{folder.rstrip('/')}/{name}", out


@contextmanager
def opened(path: str) -> Iterator[object]:
    """A file for random access."""
    where, base = fs.FileSystem.from_uri(path)
    with where.open_input_file(base) as file:
        yield file
