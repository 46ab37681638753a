"""How well flags match known labels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallywatch.functions.columns import quoted
from tallywatch.operators.report import aggregate


def label_eval(rows: DataFrame, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """Per pattern, from a (flagged, injected) pair of row conditions: true positives,
    flagged, injected, precision and recall. One aggregate for all patterns."""
    counts, result = [], []
    for i, (name, (flagged, injected)) in enumerate(patterns.items()):
        counts += [f"count_if(({flagged}) AND ({injected})) AS tp_{i}", f"count_if({flagged}) AS fl_{i}",
                   f"count_if({injected}) AS in_{i}"]
        result.append(
            f"struct({quoted(name)} AS pattern, tp_{i} AS true_positive, fl_{i} AS flagged, in_{i} AS injected,"
            f" round(try_divide(CAST(tp_{i} AS DOUBLE), fl_{i}), 4) AS precision,"
            f" round(try_divide(CAST(tp_{i} AS DOUBLE), in_{i}), 4) AS recall)")
    return aggregate(rows, [], *counts).selectExpr(f"inline(array({', '.join(result)}))")
