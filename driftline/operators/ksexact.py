"""The exact two-sample KS p-value of small samples.

Under equal distributions every order of the n + m pooled values is as likely, so a sample
pair is a random lattice path from (0, 0) to (n, m), and p is the chance that a path gets
as far from the diagonal as the measured one. The chance of being at each point without
having been that far is carried along the path's steps, and what crosses the line is
added up: only positive numbers are summed, so small p keep their digits. A step costs the
points inside the band, so a pair of 10,000 each takes 20,000 vector steps."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the exact form is used when neither sample has more rows.
EXACT_ROWS = 10_000


def path_pvalue(d: float, n: int, m: int) -> float:
    """P(D >= d) for samples of n and m values without ties."""
    a, c = sorted((int(n), int(m)))
    far = round(d * a * c)                       # |i / a - j / c| >= d  <=>  |i c - j a| >= far
    if far <= 0:
        return 1.0
    p, low, q = 0.0, 0, np.ones(1)               # q[k]: at i = low + k after t steps, never far
    for t in range(a + c):
        i = np.arange(low, low + len(q))
        up = q * (a - i) / (a + c - t)
        q = np.append(q - up, 0.0)
        q[1:] += up
        # the points (i, t + 1 - i) that are not far: |i (a + c) - (t + 1) a| < far
        first = max(low, ((t + 1) * a - far) // (a + c) + 1)
        last = min(low + len(q) - 1, -(-((t + 1) * a + far) // (a + c)) - 1)
        inside = q[first - low:last + 1 - low] if last >= first else q[:0]
        p += q[:first - low].sum() + q[last + 1 - low:].sum() if len(inside) else q.sum()
        if not len(inside):
            break
        low, q = first, inside
    return float(min(1.0, p))


@F.pandas_udf(T.DoubleType())
def exact_pvalue(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Exact p of (D, n_ref, n_cur); null where a sample is empty or has over EXACT_ROWS rows."""
    for d, n, m in batches:
        yield pd.Series([path_pvalue(x, a, b) if x == x and x is not None and 0 < a <= EXACT_ROWS and 0 < b <= EXACT_ROWS
                         else None for x, a, b in zip(d, n, m)], dtype="float64")
