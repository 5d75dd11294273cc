"""DataFrame operators: each takes and returns DataFrames.

The only actions are bounded control reads: the sampled hot-key routing of
the skew-aware duplicate ranking and the row-count guard of defect injection.
"""
