"""Run the whole pipeline.

``spark-submit --py-files kitchenlight.zip run_pipeline.py <inspections> <violations> <seed> <centroids> <out> <home zip>``
"""

import sys

from pyspark.sql import SparkSession

from kitchenlight.plans.pipeline import Inputs, run_all


def main(args: list[str]) -> None:
    if len(args) != 6:
        sys.exit(__doc__)
    inspections, violations, seed, centroids, out, home_zip = args
    spark = SparkSession.builder.appName("kitchenlight").getOrCreate()
    run_all(spark, Inputs(inspections, violations, seed, centroids), out, home_zip)


if __name__ == "__main__":
    main(sys.argv[1:])
