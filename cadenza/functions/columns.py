"""Column functions: built-in expressions composed into the small pieces the operators share.

All of them stay inside Catalyst (no Python per row), so they take part in whole-stage
code generation wherever they are used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the original pipeline: keep one interaction in three, the positions
# with (track_seq + 2) % 3 == 0, i.e. 1, 4, 7, ...
SAMPLE_EVERY = 3
SAMPLE_PHASE = 1


def systematic_sample(seq: Column, every: int = SAMPLE_EVERY, phase: int = SAMPLE_PHASE) -> Column:
    """Predicate keeping positions ``phase, phase + every, ...`` of a 1-based sequence."""
    if every < 1:
        raise ValueError("every must be >= 1")
    return ((seq + (every - phase)) % every) == 0


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with 0/0 (and x/0) → 0 instead of an ANSI error."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def l2_norm(vec: Column | str) -> Column:
    """Length of a vector column, in double precision."""
    return F.sqrt(F.aggregate(vec, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x))


def blend_arrays(offline: F.Column, online: F.Column, k: F.Column | int) -> F.Column:
    """Array twin of :func:`blend` for list-valued columns.

    ``zip_with`` pads the shorter list with nulls, so only the first ``2m`` entries of the
    flattened pairs are kept; the rest of the longer list follows; ``array_distinct``
    keeps first occurrences in order.
    """
    k = F.lit(k) if isinstance(k, int) else k
    m = F.least(F.size(offline), F.size(online))
    interleaved = F.slice(F.flatten(F.zip_with(offline, online, lambda a, b: F.array(a, b))), F.lit(1), 2 * m)
    longer = F.when(F.size(offline) >= F.size(online), offline).otherwise(online)
    rest = F.slice(longer, m + 1, F.size(longer) - m)
    return F.slice(F.array_distinct(F.concat(interleaved, rest)), F.lit(1), k)
