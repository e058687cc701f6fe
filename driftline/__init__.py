"""driftline: Spark-native monitoring of deployed binary classifiers.

Reference profiles, per-feature PSI and KS drift, score drift, label-based
quality, signals, the decision ladder, threshold sweeps, the promotion gate and
time-ordered training windows, all as DataFrame / Spark SQL / Structured
Streaming jobs.
"""

__version__ = "0.1.0"
