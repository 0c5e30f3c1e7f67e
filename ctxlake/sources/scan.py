"""File scans: one row per document, ``(file_path, content)``.

``file_path`` is relative to the scanned folder. Listing and reading are Spark's
own text and JSON sources, so a fleet of files spreads over the executors.
"""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import unix_newlines


def _below(base: str, path: Column) -> Column:
    parsed = urlparse(base)
    root = (parsed.path if parsed.scheme else os.path.abspath(base)).rstrip("/")
    plain = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.substr(plain, F.lit(len(root) + 2))


def relative_path(base: str, url: str = "_metadata.file_path") -> Column:
    """A file URL decoded and cut down to the part below ``base``."""
    return _below(base, F.url_decode(F.replace(F.col(url), F.lit("+"), F.lit("%2B"))))


def listing(spark: SparkSession, base: str, suffix: str) -> DataFrame:
    """Files ending in ``suffix`` anywhere below ``base``: ``(file_path, length, modified)``.

    Names and sizes come from a scan whose content is pruned, so no file is opened. File scans skip files of length zero.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(base.rstrip("/"))
    return files.select(_below(base, F.col("path")).alias("file_path"), "length", F.col("modificationTime").alias("modified"))


def documents_since(spark: SparkSession, base: str, suffix: str, wanted: DataFrame) -> DataFrame:
    """Texts of the files in ``wanted(file_path, modified)``, a part of a ``listing``.

    Files older than the oldest wanted one are left out by the scan itself and not opened.
    """
    oldest = wanted.agg(F.min("modified")).first()[0]
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(base.rstrip("/"))
        .filter(F.col("modificationTime") >= F.lit(oldest))
    )
    text = unix_newlines(F.expr("make_valid_utf8(CAST(content AS STRING))"))
    docs = files.select(_below(base, F.col("path")).alias("file_path"), text.alias("content"))
    return docs.join(wanted.select("file_path"), "file_path", "left_semi")


def text_documents(
    spark: SparkSession,
    base: str,
    suffix: str,
    *,
    recursive: bool = True,
    required: bool = True,
    empty_files: bool = True,
) -> DataFrame:
    """Whole files ending in ``suffix`` below ``base``.

    Undecodable bytes become U+FFFD and line ends become ``\\n``. With
    ``required`` an empty result raises FileNotFoundError. File scans skip files of
    length zero; ``empty_files`` adds them from the file listing, which costs a second
    look at the files. Turn it off where empty files do not matter.
    """
    reader = spark.read.option("pathGlobFilter", f"*{suffix}")
    target = base.rstrip("/")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    else:
        target = f"{target}/*{suffix}"
    try:
        files = reader.text(target, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if not required and os.path.isdir(base):
            return spark.createDataFrame([], "file_path string, content string")
        raise FileNotFoundError(f"no *{suffix} files found in {base}") from error
    docs = files.select(
        relative_path(base).alias("file_path"),
        unix_newlines(F.expr("make_valid_utf8(value)")).alias("content"),
    )
    if empty_files:
        listed = spark.createDataFrame([(f,) for f in files.inputFiles()], "url string")
        listed = listed.select(relative_path(base, "url").alias("file_path")).distinct()
        empty = listed.join(docs.select("file_path"), "file_path", "left_anti")
        docs = docs.unionByName(empty.withColumn("content", F.lit("")))
    if required and docs.isEmpty():
        raise FileNotFoundError(f"no *{suffix} files found in {base}")
    return docs


def documents(df: DataFrame, path: str = "file_path", content: str = "content") -> DataFrame:
    """Documents already held in a table, in the shape the parsers take."""
    return df.select(
        F.col(path).alias("file_path"), unix_newlines(F.col(content)).alias("content")
    )
