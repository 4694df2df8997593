"""An export laid out as files, one folder of an article, by a Python data source.

Every task writes into a folder of its own attempt and reports it when it is
through; the driver then writes one manifest of the reported folders, and
`publish_files` one pointer to it (S10).  What no manifest names does not
exist for readers: attempts that failed or ran twice leave nothing to be seen,
and a job that fails takes its own folder away.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .stores import point, pointer

FORMAT = "article_files"

# The files of an article and the export columns they hold; a NULL column gives no file.
FILES = {"meta.json": "meta_json", "formatted_content.html": "formatted_content_html",
         "ori_content.html": "ori_content_html", "formatted_text.txt": "formatted_text_txt"}


def _filesystem(path: str):
    """(file system, path in it) of a URI, or of a path on a folder that all machines share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _put(system, path: str, text: str) -> None:
    with system.open_output_stream(path) as f:
        f.write(text.encode("utf-8"))


@dataclass
class Written(WriterCommitMessage):
    folder: str
    articles: int
    files: int


class FilesWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.job = uuid.uuid4().hex

    def write(self, iterator) -> Written:
        from pyspark import TaskContext
        task = TaskContext.get()
        system, root = _filesystem(self.path)
        name = f"{self.job}/part-{task.partitionId():05d}-{task.taskAttemptId()}"
        folder, articles, files = f"{root}/{name}", 0, 0
        try:
            for row in iterator:
                at = f"{folder}/{row['yyyymm']}/{row['uuid']}"
                system.create_dir(at, recursive=True)
                texts = {f: row[c] for f, c in FILES.items()} | {row["status_file"]: row["status_body"]}
                for file, text in texts.items():
                    if file is not None and text is not None:
                        _put(system, f"{at}/{file}", text)
                        files += 1
                articles += 1
        except BaseException:
            _drop(system, folder)
            raise
        return Written(name, articles, files)

    def commit(self, messages) -> None:
        """One manifest, in its place only when it is whole; its folders are as many as tasks with rows."""
        system, root = _filesystem(self.path)
        done = [m for m in messages if m is not None and m.articles]
        text = "".join(json.dumps({"folder": m.folder, "articles": m.articles, "files": m.files}) + "\n" for m in done)
        system.create_dir(root, recursive=True)
        _put(system, f"{root}/{self.job}.tmp", text)
        system.move(f"{root}/{self.job}.tmp", f"{root}/manifest-{self.job}.json")

    def abort(self, messages) -> None:
        system, root = _filesystem(self.path)
        _drop(system, f"{root}/{self.job}")


def _drop(system, folder: str) -> None:
    from pyarrow import fs
    if system.get_file_info(folder).type == fs.FileType.Directory:
        system.delete_dir(folder)


class ArticleFiles(DataSource):
    """``df.write.format("article_files").mode("append").save(path)`` for frames of `stores.export_frame`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        if overwrite:
            raise ValueError("article files are never overwritten: write to a new path")
        return FilesWriter(self.options["path"])


def publish_files(export: DataFrame, out_dir: str, batch_id: int) -> str:
    """``export`` as files under a new name, then one pointer; the path of the data.

    ``<part>/<yyyymm>/<uuid>/`` holds an article's record, contents and text
    (only what its status gives it) and a file named after the status.  One
    row of a uuid is expected; an empty export is published as such.
    """
    spark, root = export.sparkSession, out_dir.rstrip("/")
    spark.dataSource.register(ArticleFiles)
    path = f"{root}/files/batch_id={batch_id}/{uuid.uuid4().hex}"
    export.write.format(FORMAT).mode("append").save(path)
    point(spark, root, batch_id, path, FORMAT)
    return path


def published_files(spark: SparkSession, out_dir: str, batch_id: int) -> DataFrame:
    """(yyyymm, uuid, name, content) of the files of the batch published last; an error if none was.

    Empty files exist but give no row: Spark's file scans pass over them.
    """
    at = pointer(spark, out_dir, batch_id)
    parts = [r["folder"] for r in spark.read.schema("folder string").json(f"{at['path']}/manifest-*.json").collect()]   # one of a task
    if not parts:
        return spark.createDataFrame([], "yyyymm string, uuid string, name string, content binary")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{at['path']}/{p}" for p in parts])
    steps = F.split("path", "/")
    return files.select(F.element_at(steps, -3).alias("yyyymm"), F.element_at(steps, -2).alias("uuid"),
                        F.element_at(steps, -1).alias("name"), "content")
