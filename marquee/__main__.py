"""Run the whole job from the command line (``spark-submit`` or ``python -m marquee``).

    python -m marquee --catalog platform_a=/data/platform_a/*.csv --catalog platform_b=/data/platform_b \\
                      --candidates /data/candidates.csv --out /data/out
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from marquee.plans.run import READERS, run_from_files


def _ints(text: str) -> tuple[int, ...]:
    return tuple(int(x) for x in text.split(","))


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="marquee", description=__doc__.splitlines()[0])
    out.add_argument("--catalog", action="append", required=True, metavar="PLATFORM=PATH",
                     help="a platform's catalogue file(s); repeat per platform")
    out.add_argument("--format", choices=sorted(READERS), default="csv", help="of the catalogue files")
    out.add_argument("--id-column", help="an integer key that is unique over all platforms")
    out.add_argument("--candidates", help="CSV of candidate titles (cand_id, platform, type, ...)")
    out.add_argument("--out", required=True, help="output folder")
    out.add_argument("--stop-words", metavar="PATH", help="text file of stop words, one a line (read by Spark)")
    out.add_argument("--types", help="title types that take part, comma-separated")
    out.add_argument("--top-n", type=_ints, metavar="D,G,T", help="sizes of the three lists")
    out.add_argument("--weight-steps", type=_ints, metavar="D,G,T", help="points between ranks of the three lists")
    out.add_argument("--year-bands", type=json.loads, metavar="JSON", help="[[first, last, points], ...]")
    out.add_argument("--target", type=json.loads, metavar="JSON", help="[low, high] of the success percentage")
    out.add_argument("--top-titles", type=int, metavar="N", help="best titles kept per segment")
    out.add_argument("--published", action="store_true", help="best titles as files of fixed names that change at once")
    return out


def job_options(spark: SparkSession, args: argparse.Namespace) -> dict:
    """What the command line sets of :class:`~marquee.plans.job.CatalogJob`."""
    given = {
        "stop_words": args.stop_words and [r.value for r in spark.read.text(args.stop_words).collect()],
        "types": args.types and args.types.split(","),
        "top_n": args.top_n,
        "weight_steps": args.weight_steps,
        "year_bands": args.year_bands and [tuple(b) for b in args.year_bands],
        "target": args.target and tuple(args.target),
        "top_titles_n": args.top_titles,
    }
    return {k: v for k, v in given.items() if v is not None}


def main(argv: list[str] | None = None) -> None:
    cli = parser()
    args = cli.parse_args(argv)
    catalogs: dict[str, list[str]] = {}
    for item in args.catalog:
        platform, _, path = item.partition("=")
        if not path:
            cli.error(f"--catalog needs PLATFORM=PATH, got {item!r}")
        catalogs.setdefault(platform, []).append(path)
    spark = SparkSession.builder.appName("marquee").getOrCreate()
    run_from_files(spark, catalogs, args.out, args.candidates, args.format, args.id_column,
                   published=args.published, **job_options(spark, args))


if __name__ == "__main__":
    main()
