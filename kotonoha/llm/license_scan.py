"""License scan by diagonal voting: where texts repeat the wording of license templates, also with words put in or left out.

Every run of ``WIDTH`` neighbouring words of a text is hashed and joined to the same runs of all templates. A hit says that
the text's word ``i`` stands where the template has word ``t``, so it votes for the diagonal ``i - t``: an unbroken copy puts
all its votes on one diagonal, and a word more or less moves the rest of it to a neighbouring one. Votes are gathered by
template and diagonal, each diagonal is merged with those up to ``DRIFT`` beyond it, and the merged span is verified: its
words, compared as words and not by hash alone, must cover as much of the template as the template demands.

Everything is DataFrame functions and one pass over the texts: templates are broadcast while they have at most
``BROADCAST_GRAMS`` runs and joined by shuffle beyond, and what moves is one narrow row for each text and for each diagonal
that got votes. Equal rows are folded before they meet, so a text that a third of all rows repeat is one row for each task.

Defined cases: null and empty texts, and texts without words, have no words, no labels, null places and the score 0; texts
of any length are read whole; repeated rows (also of a null id) give repeated results; an id with several texts gives a row
for each; an empty table gives no rows; other columns are ignored. Places that overlap count each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WIDTH = 3
DRIFT = 8
BROADCAST_GRAMS = 100_000
SHORT = 12  # templates of fewer words must stand whole
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Lower-case words; of ``share`` of them a span must have to count. ``base`` marks the fixed phrases."""

    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def share(self) -> float:
        return 1.0 if len(self.words) < SHORT else 0.6


# The query's phrases, then usual notices in their published wording.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("gpl", "gnu general public license"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
)


def _grams(spark: SparkSession, templates: tuple[Template, ...]) -> tuple[DataFrame, int]:
    """(hash, words, template, at, label, size, needed, base) of every run of words of the templates, and how many there are."""
    rows = []
    for number, t in enumerate(templates):
        if len(t.words) < WIDTH:
            raise ValueError(f"a template needs {WIDTH} words: {t.text}")
        needed = -(-len(t.words) * round(100 * t.share) // 100)
        rows += [(*t.words[at : at + WIDTH], number, at, t.label, len(t.words), needed, t.base) for at in range(len(t.words) - WIDTH + 1)]
    names = [f"t{k}" for k in range(WIDTH)]
    grams = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + ", template int, at int, label string, size int, needed int, base boolean")
    return grams.withColumn("gram", F.xxhash64(*names)), len(rows)


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans), one for each row of ``docs``.

    ``score`` is the largest part of any template that a merged span covers. ``spans`` has (label, first_word, last_word) of
    every verified span; the merged spans of one copy of a template overlap.
    """
    grams, n = _grams(docs.sparkSession, templates)
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), F.lit(f"({WORD})"), F.lit(1))
    key = ["doc_id", "_h", "_c", "_l"]
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("_h"), F.crc32(F.col("text").cast("binary")).alias("_c"), F.octet_length("text").alias("_l"), words.alias("_w")
    ).withColumn("n_words", F.size("_w").cast("long"))
    # Row -1 stands for the text itself and is in no run; each other row is a word and those after it.
    runs = texts.select(
        *key, "n_words",
        F.inline(F.arrays_zip(
            F.sequence(F.lit(-1), F.size("_w") - 1).alias("i"), F.concat(F.array(F.lit(None).cast("string")), "_w").alias("w0"),
            *[F.concat(F.array(F.lit(None).cast("string")), F.slice("_w", k + 1, F.size("_w"))).alias(f"w{k}") for k in range(1, WIDTH)],
        )),
    )
    gram = F.when(F.col("i") >= 0, F.xxhash64(*[f"w{k}" for k in range(WIDTH)]))
    same = F.lit(True)
    for k in range(WIDTH):
        same = same & F.coalesce(F.col(f"w{k}") == F.col(f"t{k}"), F.lit(False))
    votes = (
        runs.withColumn("gram", gram).join(F.broadcast(grams) if n <= BROADCAST_GRAMS else grams, "gram", "left")
        .where(same | (F.col("i") < 0))
        .groupBy(*key, "n_words", "template", "label", "size", "needed", "base", (F.col("i") - F.col("at")).alias("diagonal"))
        .agg(F.collect_set("at").alias("hit"), F.count(F.when(F.col("i") < 0, 1)).alias("copies"))
    )
    # Neighbouring diagonals together: at most DRIFT + 1 of them, each with no more places than the template has.
    near = Window.partitionBy(*key, "template").orderBy("diagonal").rangeBetween(0, DRIFT)
    merged = votes.repartition(*key).withColumns({
        "together": F.array_distinct(F.flatten(F.collect_list("hit").over(near))),
        "first": F.min(F.col("diagonal") + F.array_min("hit")).over(near), "last": F.max(F.col("diagonal") + F.array_max("hit") + WIDTH - 1).over(near),
    })
    covered = F.size(F.array_distinct(F.flatten(F.transform("together", lambda t: F.sequence(t, t + F.lit(WIDTH - 1))))))
    merged = merged.withColumn("covered", F.when(F.col("template").isNotNull(), covered))
    whole = F.col("base") & (F.size("hit") == F.col("size") - WIDTH + 1)
    verified = F.col("covered") >= F.col("needed")
    found = merged.groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal").cast("long"))).alias("first_word"), F.max(F.when(whole, F.col("diagonal").cast("long"))).alias("last_word"),
        _joined(F.collect_set(F.when(whole, F.col("label")))).alias("base_labels"),
        # Merged spans of base phrases add nothing to the phrases themselves.
        _joined(F.collect_set(F.when(whole | (~F.col("base") & verified), F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(whole, F.lit(1.0)).when(~F.col("base"), F.col("covered") / F.col("size"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_set(F.when(whole | (~F.col("base") & verified), F.struct("label", F.when(whole, F.col("diagonal")).otherwise(F.col("first")).alias("first_word"), F.when(whole, F.col("diagonal") + F.col("size") - 1).otherwise(F.col("last")).alias("last_word"))))).alias("spans"),
        F.sum("copies").alias("copies"),
    )
    found = found.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def _joined(labels):
    return F.array_join(F.sort_array(labels), ",")


def oracle_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The same in DuckDB, words joined as words; rows of an id and text are told apart by their place in the table."""
    values = ", ".join(f"({i}, '{t.label}', {len(t.words)}, {-(-len(t.words) * round(100 * t.share) // 100)}, {str(t.base).lower()}, string_split('{t.text}', ' '))" for i, t in enumerate(templates))
    return rf"""
WITH t(template, label, size, needed, base, ws) AS (VALUES {values}
), g AS (
  SELECT template, label, size, needed, base, k - 1 AS p, ws[k] AS a, ws[k + 1] AS b, ws[k + 2] AS c FROM (SELECT *, unnest(range(1, size - 1)) AS k FROM t)
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS ws FROM documents
), w AS (
  SELECT r, k - 1 AS i, ws[k] AS a, ws[k + 1] AS b, ws[k + 2] AS c FROM (SELECT *, unnest(range(1, len(ws) - 1)) AS k FROM d)
), v AS (
  SELECT DISTINCT r, template, label, size, needed, base, p, i - p AS diagonal FROM w JOIN g USING (a, b, c)
), hits AS (
  SELECT r, template, label, size, needed, base, diagonal, count(*) AS n FROM v GROUP BY ALL
), marks AS (
  SELECT h.r, h.template, h.label, h.size, h.needed, h.base, h.diagonal, h.n, unnest([v.p, v.p + 1, v.p + 2]) AS covers
  FROM hits h JOIN v ON h.r = v.r AND h.template = v.template AND v.diagonal BETWEEN h.diagonal AND h.diagonal + {DRIFT}
), m AS (
  SELECT r, label, size, needed, base, diagonal, n, count(DISTINCT covers) AS covered FROM marks GROUP BY r, template, label, size, needed, base, diagonal, n
), f AS (
  SELECT r, count(*) FILTER (base AND n = size - 2) AS n_base, min(diagonal) FILTER (base AND n = size - 2) AS first_word, max(diagonal) FILTER (base AND n = size - 2) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND n = size - 2) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER ((base AND n = size - 2) OR (NOT base AND covered >= needed)) AS labels,
         max(CASE WHEN base AND n = size - 2 THEN 1.0::DOUBLE WHEN NOT base THEN covered::DOUBLE / size END) AS score
  FROM m GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN f USING (r)
"""


ORACLE_SQL = oracle_sql()
