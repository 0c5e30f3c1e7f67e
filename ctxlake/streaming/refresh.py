"""New or changed source files → parsed rows → upsert into the catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import unix_newlines
from ..operators import lookml
from ..operators.publish import publish_skills
from ..operators.store import Catalog, last_write_wins
from ..runtime import scratch
from ..sources.lookml import parse_lookml
from ..sources.scan import relative_path
from ..specs import ALL_TABLES


def document_stream(
    spark: SparkSession, base: str, suffix: str, *, files_per_batch: int = 10_000
) -> DataFrame:
    """Whole files as they arrive: ``(file_path, content, modified)``.

    A changed file counts as new when its name changes or when it lands under a
    new folder; the newest one wins in a batch.
    """
    files = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(base)
    )
    return files.select(
        relative_path(base).alias("file_path"),
        unix_newlines(F.expr("make_valid_utf8(value)")).alias("content"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def refresh_stream(
    docs: DataFrame, publish: Callable[[DataFrame], object], checkpoint: str
) -> StreamingQuery:
    """Hand every document that arrived since the last run to ``publish``, then stop.

    ``publish`` must be an upsert by key, so that a batch replayed after a failure
    gives the same tables.
    """

    def each(batch: DataFrame, _: int) -> None:
        publish(last_write_wins(batch, ["file_path"], "modified").drop("modified"))

    return (
        docs.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_skills_stream(
    docs: DataFrame, catalog: Catalog, provider: str, checkpoint: str
) -> StreamingQuery:
    return refresh_stream(docs, lambda batch: publish_skills(catalog, batch, provider), checkpoint)


def refresh_lookml_stream(docs: DataFrame, catalog: Catalog, checkpoint: str) -> StreamingQuery:
    """Upsert the blocks of new LookML files; names are unique in a well-formed project."""

    def publish(batch: DataFrame) -> None:
        with scratch(parse_lookml(batch), "lookml") as blocks:
            for name, rows in lookml.family(blocks).items():
                spec = ALL_TABLES[name]
                catalog.upsert(spec, rows.dropDuplicates(list(spec.keys)))

    return refresh_stream(docs, publish, checkpoint)
