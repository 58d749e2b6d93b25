"""Comparison run: predictions against the reference coding."""

from __future__ import annotations

from pyspark.sql import SparkSession

from gavelframe.operators import comparison as cp
from gavelframe.session import cut, passing_cuts
from gavelframe.sources import records, sinks


def run(
    spark: SparkSession,
    predictions_path: str,
    truth_path: str,
    comparison_path: str,
    mismatches_path: str,
    summary_path: str,
) -> dict[str, int]:
    """Write row table, long list and summary; return the totals."""
    with passing_cuts(spark):
        predictions = records.read_predictions(spark, predictions_path)
        # Read twice, for the check of the keys and for the join: the reference is parsed once.
        truth = cut(records.read_truth_csv(spark, truth_path), "truth")
        cp.validate_keys(predictions, "predictions")
        cp.validate_keys(truth, "ground truth")
        rows, fields = cp.judge_cells(predictions, truth)
        rows = cut(cp.compact(rows, fields), "comparison")
        sinks.write_comparison(
            cp.wide_rows(rows, fields),
            cp.mismatch_rows(rows, fields),
            cp.summary_rows(rows, fields),
            comparison_path,
            mismatches_path,
            summary_path,
        )
        return cp.compare_totals(rows, fields).head().asDict()
