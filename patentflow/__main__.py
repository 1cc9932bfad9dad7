"""The jobs from a command line: python -m patentflow extract|ingest|top|label|fit|score ..."""

import argparse
from datetime import date

from pyspark.sql import SparkSession

from patentflow.operators.labeling import MAX_NEGATIVES
from patentflow.plans import jobs
from patentflow.session import build_session
from patentflow.storage import remove_scratch
from patentflow.streaming.archives import ingest_archives


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="patentflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    extract = commands.add_parser("extract", help="archives -> patents, word counts, top words")
    extract.add_argument("archives")
    extract.add_argument("out")
    extract.add_argument("--glob", default="*")
    extract.add_argument("--max-rows", type=int, default=None, help="bound on rows per file")

    ingest = commands.add_parser("ingest", help="archives that are new since the last call -> patents, word counts")
    ingest.add_argument("archives")
    ingest.add_argument("out")
    ingest.add_argument("--glob", default="*")
    ingest.add_argument("--per-batch", type=int, default=None, help="bound on archives a batch")

    top = commands.add_parser("top", help="word counts of several runs -> merged top words")
    top.add_argument("out")
    top.add_argument("counts", nargs="+")

    label = commands.add_parser("label", help="archives + list of positives -> training table")
    label.add_argument("archives")
    label.add_argument("positives")
    label.add_argument("out")
    label.add_argument("--glob", default="*")
    label.add_argument("--max-negatives", type=int, default=MAX_NEGATIVES)
    label.add_argument("--documents", default=None, help="also keep the raw documents here")

    fit = commands.add_parser("fit", help="training table -> model and dictionaries")
    fit.add_argument("training")
    fit.add_argument("model")

    score = commands.add_parser("score", help="patents + model -> energy patents of a run date")
    score.add_argument("patents")
    score.add_argument("model")
    score.add_argument("out")
    score.add_argument("--day", default=date.today().isoformat())
    score.add_argument("--skip-unreadable", action="store_true", help="leave broken parts out")
    return parser.parse_args()


def main() -> None:
    given = arguments()
    spark = build_session()
    try:
        run(spark, given)
    finally:
        remove_scratch(spark)


def run(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.command == "extract":
        damaged = jobs.extract_job(spark, given.archives, given.out, given.glob, given.max_rows)
        print({"damaged": damaged})
    elif given.command == "ingest":
        ingest_archives(spark, given.archives, given.out, given.glob, given.per_batch)
    elif given.command == "top":
        jobs.write_top_words(spark, given.out, *given.counts)
    elif given.command == "label":
        damaged = jobs.training_job(
            spark,
            given.archives,
            given.positives,
            given.out,
            given.glob,
            given.max_negatives,
            given.documents,
        )
        print({"damaged": damaged})
    elif given.command == "fit":
        print({"accuracy": jobs.fit_job(spark, given.training, given.model)})
    else:
        jobs.score_job(
            spark, given.patents, given.model, given.out, given.day, given.skip_unreadable
        )


if __name__ == "__main__":
    main()
