"""`file_tree`: write rows as files, one row per file.

    df.select("path", "content").write.format("file_tree").mode("append").save(root)

`path` is relative to the root. A file that exists already is left alone, so a
repeated task or a repeated run changes nothing; this is what an immutable,
content-addressed pool needs. `overwrite_files=true` replaces files instead.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from lettermill.sources.files import local_path, remote


@dataclass
class FilesWritten(WriterCommitMessage):
    written: int


class FileTreeWriter(DataSourceWriter):
    def __init__(self, root: str, replace: bool):
        self.root = root
        self.replace = replace

    def write(self, iterator: Iterator) -> FilesWritten:
        put = self._local() if local_path(self.root) is not None else self._remote()
        return FilesWritten(sum(put(row.path, bytes(row.content)) for row in iterator))

    def _local(self):
        root = local_path(self.root)
        replace = self.replace

        def put(rel: str, content: bytes) -> int:
            target = os.path.join(root, rel)
            if os.path.exists(target) and not replace:
                return 0
            folder = os.path.dirname(target)
            os.makedirs(folder, exist_ok=True)
            # Written aside and renamed: readers never see half a file. The
            # leading dot keeps a leftover of a lost task apart from results.
            aside = os.path.join(folder, f".{uuid.uuid4().hex}.part")
            with open(aside, "wb") as f:
                f.write(content)
            os.replace(aside, target)
            return 1

        return put

    def _remote(self):
        from pyarrow import fs

        filesystem, base = remote(self.root)
        replace = self.replace

        def put(rel: str, content: bytes) -> int:
            target = f"{base.rstrip('/')}/{rel}"
            if not replace and filesystem.get_file_info(target).type == fs.FileType.File:
                return 0
            filesystem.create_dir(target.rsplit("/", 1)[0], recursive=True)
            aside = f"{target}.{uuid.uuid4().hex}.part"
            with filesystem.open_output_stream(aside) as out:
                out.write(content)
            filesystem.move(aside, target)
            return 1

        return put

    def commit(self, messages) -> None:
        """Files are published one by one; nothing is left to do."""

    def abort(self, messages) -> None:
        """Files already there are valid on their own."""


class FileTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        replace = overwrite or self.options.get("overwrite_files", "false") == "true"
        return FileTreeWriter(self.options["path"], replace)
