"""spark-submit entry point: score a CSV with a model that run_analysis saved.

    spark-submit run_scoring.py MODEL_FOLDER SCORING_CSV OUT_DIR [--version N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyframe.plans import score_with_saved


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("model_folder")
    parser.add_argument("scoring_csv")
    parser.add_argument("out_dir")
    parser.add_argument("--version", type=int, default=None)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tallyframe-scoring").getOrCreate()
    results = score_with_saved(spark, args.model_folder, args.scoring_csv, args.out_dir, args.version)
    results["scoring_rows_faults"].show(truncate=False)
    results["new_predictions"].show()
    spark.stop()


if __name__ == "__main__":
    main()
