"""Ridge regression of any number of groups from sufficient statistics.

A row's vector ``z`` holds its design columns and the target. One hash aggregate per (group, column) sums ``z[i] * z``,
so the Gram matrix of a group is summed map-side wherever its rows lie: no group of rows is ever gathered, and Python
sees one matrix of fixed size per group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerflow.shipping import ship_package


def gram(rows: DataFrame, keys: Sequence[str], vector: str, size: int) -> DataFrame:
    """The keys and ``gram``, the matrix sum of ``z z'`` of each group, row by row in one array; ``z`` has no nulls."""
    one = rows.select(*keys, F.col(vector).alias("__z"), F.posexplode(vector).alias("__i", "__x"))
    sums = F.expr(f"array({', '.join(f'sum(__x * __z[{j}])' for j in range(size))})")
    lines = one.groupBy(*keys, "__i").agg(sums.alias("__line"))
    whole = F.flatten(F.sort_array(F.collect_list(F.struct("__i", "__line"))).getField("__line"))
    return lines.groupBy(*keys).agg(whole.alias("gram"))


def ridge(moments: np.ndarray, products: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Weights ``w`` with ``(X'X + diag(penalty)) w = X'y``; the tiny term keeps unused columns at zero."""
    return np.linalg.solve(moments + np.diag(penalty + 1e-9), products)


def solved(matrices: DataFrame, solve: Callable[[dict], dict[str, object]], drop: str, columns: str) -> DataFrame:
    """Apply ``solve`` to each row of ``matrices`` (as a dictionary) and add its ``columns``; the column ``drop`` goes."""
    ship_package(matrices.sparkSession)
    names = [part.split()[0] for part in columns.split(", ")]
    kept = [f for f in matrices.schema.fields if f.name != drop]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([solve(row) for row in batch.to_dict("records")], columns=names, index=batch.index)
            yield pd.concat([batch[[f.name for f in kept]], found], axis=1)

    return matrices.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), columns]))
