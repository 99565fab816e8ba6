"""Streaming forms of the one-pass tables: stateless per page, so no watermark and no state is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import plans
from ..sources.pages import stream_pages, stream_phonemes

#: Synonyms keep state and have a module of their own; ``against_batch`` joins sources that a batch run found instead.
TABLES = {"readings": plans.readings, "english": plans.english_words, "categories": plans.categories, "characters": plans.characters}


def table(spark: SparkSession, name: str, path: str, options: plans.Options = plans.Options()) -> DataFrame:
    """A streaming table of pages or phonemes that arrive in a folder."""
    if name == "phonemes":
        return plans.phonetic_dictionary(stream_phonemes(spark, path), options)
    return TABLES[name](stream_pages(spark, path), options)


def against_batch(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Streaming pages with the sources that a batch run found for their titles."""
    return pages.join(sources.withColumnRenamed("target", "title"), "title", "left")


def write(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to Parquet once for each row, also over restarts."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
