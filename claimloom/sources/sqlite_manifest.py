"""SQLite manifests as a Python data source: the table with a path column, opened read-only."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

#: Preferred tables, path columns and metadata columns in order (fixed values).
TABLES = ["documents", "document", "files", "file", "items", "manifest"]
PATHS = ["markdown_path", "markdown_file", "markdown_filepath", "md_path", "md_file", "relative_path", "local_path", "file_path", "filepath", "path", "file"]
METADATA = {
    "document_id": ["document_id", "id", "uuid", "key"],
    "doi": ["doi", "doi_url"],
    "title": ["title", "name"],
    "authors": ["authors", "author"],
    "year": ["year", "publication_year", "published_year", "date"],
    "journal": ["journal", "publication", "container_title", "source"],
    "slug": ["slug", "filename", "stem"],
}
_SCHEMA = "ord int, path string, document_id string, doi string, title string, authors string, year string, journal string, slug string"


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def read(self, partition):
        import os
        import sqlite3

        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            names = [r[0] for r in db.execute("select name from sqlite_master where type = 'table' and name not like 'sqlite_%' order by name")]
            columns = {n: [r[1].lower() for r in db.execute(f"pragma table_info({_quoted(n)})")] for n in names}
            ranked = sorted(names, key=lambda n: (TABLES.index(n.lower()) if n.lower() in TABLES else len(TABLES), n))
            table = next((n for n in ranked if any(p in columns[n] for p in PATHS)), None)
            if table is None:
                raise ValueError("no table with a path column")
            path = next(p for p in PATHS if p in columns[table])
            chosen = [next((c for c in cs if c in columns[table]), None) for cs in METADATA.values()]
            fields = ", ".join([_quoted(path), *[_quoted(c) if c else "null" for c in chosen]])
            number = 0
            for row in db.execute(f"select {fields} from {_quoted(table)} order by rowid"):
                if row[0] and str(row[0]).lower().endswith((".md", ".markdown", ".mdown")):
                    number += 1
                    full = str(row[0]) if os.path.isabs(str(row[0])) else os.path.join(os.path.dirname(self.path), str(row[0]))
                    yield (number, full, *[None if v is None else str(v) for v in row[1:]])


class SqliteManifest(DataSource):
    """spark.read.format("sqlite_manifest").load(path)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_manifest"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteManifest)
