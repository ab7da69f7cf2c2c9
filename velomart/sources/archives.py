"""Zip archives of CSV members, read as rows."""

from __future__ import annotations

import io
import itertools
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart.functions.names import file_kind, last_segment

# Lines per batch handed to the JVM: bounds a task's memory by the archive's
# compressed size plus one batch, however long its members are.
_BATCH_LINES = 20_000


def _is_table(member: str) -> bool:
    """CSV members, without the shadow files that some packers add."""
    name = member.rsplit("/", 1)[-1]
    hidden = name.startswith("._") or "__MACOSX" in member.split("/")[:-1]
    return name.lower().endswith(".csv") and not hidden


def _lines(encoding: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in filter(_is_table, archive.namelist()):
                        with archive.open(member) as raw:
                            yield from _member(path, member, raw, encoding)

    return run


def _member(path: str, member: str, raw, encoding: str) -> Iterator[pd.DataFrame]:
    text = io.TextIOWrapper(raw, encoding=encoding)
    filled = (line.rstrip("\n") for line in text if line.strip())
    for first in itertools.count(0, _BATCH_LINES):
        lines = list(itertools.islice(filled, _BATCH_LINES))
        if not lines:
            return
        out = pd.DataFrame({"line_no": range(first, first + len(lines)), "line": lines})
        yield out.assign(path=path, member=member)[
            ["path", "member", "line_no", "line"]
        ]


def archive_lines(archives: DataFrame, encoding: str = "utf-8-sig") -> DataFrame:
    """Non-blank lines, numbered from 0, of the CSV members of archives ``(path, content)``.

    One archive is read by one task, since a deflated member cannot be entered
    in the middle; members are inflated line by line and never held whole. Shadow
    files of packers are no members. Bytes that the encoding lacks are an error.
    """
    return archives.select("path", "content").mapInPandas(
        _lines(encoding), "path string, member string, line_no long, line string"
    )


def unpack_archives(
    archives: DataFrame,
    schema: T.StructType,
    header: bool = True,
    kind: str | None = None,
    encoding: str = "utf-8-sig",
) -> DataFrame:
    """Rows of the CSV members of archives ``(path, content)``.

    ``kind`` keeps only members whose name says they hold trips or stations (see
    ``file_kind``). A header is the first line that is not blank.
    """
    lines = archive_lines(archives, encoding)
    if kind is not None:
        lines = lines.filter(file_kind(last_segment(F.col("member"))) == kind)
    if header:
        lines = lines.filter(F.col("line_no") > 0)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    row = F.from_csv(F.col("line"), ddl)
    return lines.select(row.alias("row")).select("row.*")


def read_archives(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    kind: str | None = None,
    encoding: str = "utf-8-sig",
) -> DataFrame:
    """Rows of the CSV members of every ``.zip`` under ``path``."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return unpack_archives(files, schema, header, kind, encoding)
