"""Binary files in the shared folder, written and read by executors through pyarrow's file systems.

A file is written under a name of its own and moved into place when it is whole, so a task that is run again, or twice
at once, leaves one complete file of the same name and content.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs


def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


@contextmanager
def writing(folder: str, name: str) -> Iterator[pa.NativeFile]:
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt, compression=None) as file:
        yield file
    system.move(attempt, f"{path}/{name}")


@contextmanager
def reading(folder: str, name: str) -> Iterator[pa.NativeFile]:
    system, path = _place(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        yield file
