"""spark-submit entry point: profile and fit on one CSV, score another, write all results.

    spark-submit run_analysis.py TRAINING_CSV SCORING_CSV OUT_DIR [--positive-label '>50K']
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyframe.operators.model import ModelParams
from tallyframe.plans import run_analysis


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("training_csv")
    parser.add_argument("scoring_csv")
    parser.add_argument("out_dir")
    defaults = ModelParams()
    parser.add_argument("--positive-label", default=defaults.positive_label)
    parser.add_argument("--label-handle-invalid", default=defaults.label_handle_invalid, choices=["keep", "error", "skip"])
    parser.add_argument("--numeric-handle-invalid", default=defaults.numeric_handle_invalid, choices=["error", "skip"])
    parser.add_argument("--keep-null-labels", action="store_true")
    parser.add_argument("--max-iter", type=int, default=defaults.max_iter)
    parser.add_argument("--reg-param", type=float, default=defaults.reg_param)
    parser.add_argument("--elastic-net", type=float, default=defaults.elastic_net)
    parser.add_argument("--max-category-values", type=int, default=None)
    parser.add_argument("--weight-col", default=None, help="column that says how many equal rows a row stands for in fit and metrics")
    parser.add_argument("--held-out", type=float, default=0.0, help="share of every class the fit does not see")
    parser.add_argument("--save-model", default=None, help="folder to save the fitted model in, as its next version")
    args = vars(parser.parse_args(argv))
    paths = [args.pop(name) for name in ("training_csv", "scoring_csv", "out_dir")]
    more = {"held_out": args.pop("held_out"), "model_root": args.pop("save_model")}

    spark = SparkSession.builder.appName("tallyframe-analysis").getOrCreate()
    results = run_analysis(spark, *paths, ModelParams(**args), **more)
    for name in ("table_counts", "training_rows_faults", "label_distribution", "metrics_report", "prediction_summary", "confidence_bands"):
        print(name)
        results[name].show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
