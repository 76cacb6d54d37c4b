"""A sink of named text files: format("named_files"), written aside by tasks and moved into place by the commit."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def _place(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@dataclass
class Written(WriterCommitMessage):
    """A task's folder of finished files."""

    folder: str


class _Writer(DataSourceWriter):
    def __init__(self, options):
        self.path, self.ending = options["path"], options.get("ending", ".md")
        self.aside = f"{self.path}/.aside-{uuid.uuid4().hex}"

    def write(self, iterator):
        """A task's files, in a folder of its own: a task that runs again starts a new one, and only that of its success is told."""
        folder = f"{self.aside}/{uuid.uuid4().hex}"
        files, place = _place(folder)
        files.create_dir(place, recursive=True)
        for name, text in iterator:
            if name is None:
                raise ValueError("a file has no name")
            with files.open_output_stream(f"{place}/{name.replace('/', '_')}{self.ending}") as out:
                out.write((text or "").encode())
        return Written(folder)

    def commit(self, messages):
        from pyarrow import fs

        files, place = _place(self.path)
        for m in messages:
            _, folder = _place(m.folder)
            for x in files.get_file_info(fs.FileSelector(folder)):
                files.move(x.path, f"{place}/{x.base_name}")
        self.abort(messages)

    def abort(self, messages):
        files, place = _place(self.aside)
        files.delete_dir_contents(place, missing_dir_ok=True)
        files.create_dir(place, recursive=True)
        files.delete_dir(place)


class NamedFiles(DataSource):
    """Rows (name, text) as files of their own; options: path, ending.  A slash in a name becomes an underscore."""

    @classmethod
    def name(cls):
        return "named_files"

    def schema(self):
        return "name string, text string"

    def writer(self, schema, overwrite):
        return _Writer(self.options)


def save(files: DataFrame, folder: str, ending: str = ".md") -> None:
    """Write every row (name, text) as a file under a folder that all executors share: all of them, or none if a task fails.

    Tasks write the texts; the driver only moves finished files, by name.
    Equal names should be reduced to one before.
    """
    files.sparkSession.dataSource.register(NamedFiles)
    files.toDF("name", "text").write.format("named_files").mode("append").option("path", folder).option("ending", ending).save()
