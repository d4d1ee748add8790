"""Column-level helpers shared by the operators."""

from cadenza.functions.columns import blend_arrays, l2_norm, safe_ratio, systematic_sample

__all__ = ["blend_arrays", "l2_norm", "safe_ratio", "systematic_sample"]
