"""Synonyms of pages that keep arriving: what leads to a title waits in the state until its article comes, and goes on after it.

Every event of a title meets in that title's state: its article states names, redirects and disambiguation pages name it as
their target, in whatever order and batch they come. Sources are a list state that is only appended to. As soon as the
article is known, each batch that changes something gives the title's whole row again with a higher ``version``; the last
version of every title is what the batch table would hold, sources in the order of their arrival instead of the export's.

The state is as large as the names that lead to pages. It is kept in RocksDB and goes through the checkpoint, so a query
that is stopped, or loses executors, goes on where it was. A page that comes again replaces its article and adds no source
twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import plans
from ..plans.modes import redirect_sources, stated_synonyms, united_synonyms
from ..sources.pages import stream_pages

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Gathered(StatefulProcessor):
    """The state of one title: its article, what leads to it, and how often it was given."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.article = handle.getValueState("article", "own array<string>, stripped string")
        self.led = handle.getListState("led", "source string")
        self.version = handle.getValueState("version", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = [x[0] for x in self.led.get()] if self.led.exists() else []
        seen, fresh, changed = set(known), [], False
        for frame in rows:
            for source, own, stripped in sorted(frame[["source", "own", "stripped"]].itertuples(index=False, name=None), key=lambda r: r[0] or ""):
                if source is None:
                    self.article.update(([str(x) for x in own], stripped))
                    changed = True
                elif source not in seen:
                    seen.add(source)
                    fresh.append(source)
        if fresh:
            self.led.appendList([(x,) for x in fresh])
        if self.article.exists() and (changed or fresh):
            version = (self.version.get()[0] if self.version.exists() else 0) + 1
            self.version.update((version,))
            own, stripped = self.article.get()
            yield pd.DataFrame({"title": [key[0]], "own": [list(own)], "stripped": [stripped], "led": [known + fresh], "version": [version]})

    def close(self) -> None:
        pass


def synonyms_of(pages: DataFrame, options: plans.Options = plans.Options()) -> DataFrame:
    """Streaming rows (title, synonyms, version) of streaming pages (title, inner)."""
    pages.sparkSession.conf.set(_PROVIDER, _ROCKS)
    articles = stated_synonyms(pages, options).select("title", F.lit(None).cast("string").alias("source"), "own", "stripped")
    led = redirect_sources(pages.withColumn("ordinal", F.lit(0).cast("long")), options)
    sources = led.select(F.col("target").alias("title"), "source", F.lit(None).cast("array<string>").alias("own"), F.lit(None).cast("string").alias("stripped"))
    kind = "title string, own array<string>, stripped string, led array<string>, version long"
    gathered = articles.unionByName(sources).groupBy("title").transformWithStateInPandas(Gathered(), kind, outputMode="append", timeMode="none")
    return united_synonyms(gathered, options)


def synonyms(spark: SparkSession, path: str, options: plans.Options = plans.Options()) -> DataFrame:
    """The streaming table of exports that arrive in a folder."""
    return synonyms_of(stream_pages(spark, path), options)


def latest(table: DataFrame) -> DataFrame:
    """(title, synonyms): the last version of every title of what the stream has written."""
    newest = Window.partitionBy("title").orderBy(F.desc("version"))
    return table.withColumn("_n", F.row_number().over(newest)).where("_n = 1").select("title", "synonyms")
