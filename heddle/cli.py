"""Daily jobs from the command line: ``python -m heddle.cli parse|dedupe|panel ...``."""

import argparse
import datetime

from pyspark.sql import SparkSession, functions as F

from heddle.functions.text import block_key
from heddle.operators import dedupe, gates, pages, panel
from heddle.plans import ranks
from heddle.plans.durable import Scratch
from heddle.session import build_session
from heddle.sources import bronze
from heddle.sources.silver import read_silver


def parse(spark: SparkSession, day: str, source: str, out: str) -> dict[str, int]:
    """Bronze of a day to silver, behind both gates."""
    silver = pages.parse_bronze(bronze.read_bronze(spark, source, day), day)
    return gates.write_gated(silver, out, datetime.date.fromisoformat(day))


def cluster(spark: SparkSession, source: str, out: str, day: str | None = None) -> None:
    """Near-duplicate clusters of silver, of all days or up to one."""
    silver = read_silver(spark, source, last=day)
    latest = silver.groupBy("listing_id").agg(F.max_by(F.struct("province", "district", "area_sqm", "asking_rent_vnd", "description_clean"), "dt").alias("r")).select("listing_id", "r.*")
    keyed = latest.select(
        "listing_id", F.col("description_clean").alias("text"), block_key(F.col("province"), F.col("district"), F.col("area_sqm"), F.col("asking_rent_vnd")).alias("block")
    )
    # listing ids become numbers by their place, which no two share
    scratch = Scratch(spark, "cluster")
    numbered = scratch.keep(ranks.numbered(keyed, ["listing_id"], "id"), "numbered")
    found = dedupe.near_duplicate_clusters(numbered, "id", "block", "text").join(numbered.select("id", "listing_id"), "id")
    # the cluster's name is its least listing id
    names = found.groupBy("canonical_id").agg(F.min("listing_id").alias("name"))
    named = found.join(names, "canonical_id").select("listing_id", F.col("name").alias("canonical_id"), "cluster_size", (F.col("listing_id") == F.col("name")).alias("is_canonical"))
    named.write.mode("overwrite").parquet(out)
    scratch.clear()


def build_panel(spark: SparkSession, censor: str, probes: str, out_panel: str, out_survival: str) -> None:
    """Probes to the panel, by month, and its survival labels."""
    rows = bronze.read_probes(spark, probes)
    bronze.write_panel(rows, out_panel)
    panel.survival_labels(rows, datetime.date.fromisoformat(censor)).write.mode("overwrite").parquet(out_survival)


def main(argv: list[str] | None = None) -> None:
    jobs = argparse.ArgumentParser(prog="heddle")
    kinds = jobs.add_subparsers(dest="job", required=True)
    for name, options in (("parse", ("date", "input", "output")), ("dedupe", ("input", "output")), ("panel", ("censor-date", "input", "output", "output-survival"))):
        job = kinds.add_parser(name)
        for option in options:
            job.add_argument(f"--{option}", required=True)
        if name == "dedupe":
            job.add_argument("--date")
    given = jobs.parse_args(argv)
    spark = build_session(f"heddle-{given.job}")
    if given.job == "parse":
        print(parse(spark, given.date, given.input, given.output))
    elif given.job == "dedupe":
        cluster(spark, given.input, given.output, given.date)
    else:
        build_panel(spark, given.censor_date, given.input, given.output, given.output_survival)


if __name__ == "__main__":
    main()
