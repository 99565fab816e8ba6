"""Command line: ``python -m kotonoha MODE INPUT OUTPUT [--case=…] [--show=…] [--aimai=…] [--format=tsv|parquet]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from . import plans
from .sources import pages, sinks

MODES = {"yomi": plans.readings, "ruigi": plans.synonyms, "eng": plans.english_words, "chara": plans.characters, "category": plans.categories, "cmudict": plans.phonetic_dictionary}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kotonoha", description=__doc__)
    parser.add_argument("mode", choices=MODES)
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--case", default="kata", choices=("kata", "kana", "none"))
    parser.add_argument("--show", default="noempty", choices=("noempty", "all", "empty"))
    parser.add_argument("--aimai", default="del", choices=("del", "keep"))
    parser.add_argument("--format", default="tsv", choices=("tsv", "parquet"))
    parser.add_argument("--rules", help="phoneme rules (stage, pattern, kana), tab-separated")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"kotonoha {args.mode}").getOrCreate()
    options = plans.Options(args.case, args.show, args.aimai)
    if args.mode == "cmudict":
        table = plans.phonetic_dictionary(pages.read_phonemes(spark, args.input), options, pages.read_rules(spark, args.rules) if args.rules else ())
        table = table.withColumn("word", _marked(table))
    else:
        table = MODES[args.mode](pages.read_pages(spark, args.input), options)
    (sinks.write_tsv if args.format == "tsv" else sinks.write_parquet)(table, args.output)


def _marked(table):
    from pyspark.sql import functions as F

    return F.concat(F.lit("@"), table["word"])


if __name__ == "__main__":
    main()
