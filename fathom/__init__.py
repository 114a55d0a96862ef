"""fathom: tabular data-science operators (profiling, contracts, drift,
folds, evaluation, survival and spatial statistics, Spark ML) written as
DataFrame -> DataFrame functions on Spark."""

__version__ = "0.1.0"
