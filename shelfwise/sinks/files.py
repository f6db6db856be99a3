"""Tables, documents and models to files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.ArrayType, T.MapType, T.StructType)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header. Nested columns are written as whole JSON text."""
    flat = df.select([
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, NESTED) else F.col(f"`{f.name}`")
        for f in df.schema
    ])
    (flat.write.mode(mode).option("header", True).option("quote", '"')
     .option("escape", '"').csv(path))


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet: vectors, boxes and pixel bytes keep their types."""
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per row."""
    df.write.mode(mode).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def write_binary_files(df: DataFrame, path: str, name: str = "file_name", content: str = "content") -> DataFrame:
    """A file per row in the folder `path`, which all executors can reach; (file_name, bytes) of those written.

    Each file is written beside its place and then moved there, so a repeated
    task replaces its own files and nobody sees half of one. Nothing is written
    before the result is read. Rows without content are left out. Names are
    plain and unique: of two rows with one name either may stay.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem
        system, root = FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and
                                           not path.startswith("file://") else path)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for row in batch.itertuples(index=False):
                if "/" in row.file_name or row.file_name in ("", ".", ".."):
                    raise ValueError(f"not a plain file name: {row.file_name}")
                part = f"{root}/.{row.file_name}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(row.content)
                system.move(part, f"{root}/{row.file_name}")
            yield pd.DataFrame({"file_name": batch["file_name"], "bytes": [len(c) for c in batch["content"]]})

    rows = df.where(F.col(name).isNotNull() & F.col(content).isNotNull()).select(
        F.col(name).alias("file_name"), F.col(content).alias("content"))
    return rows.mapInPandas(write, "file_name string, bytes bigint")
