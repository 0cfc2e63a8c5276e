"""tabforge: tabular ML preparation as Spark DataFrame operators.

Every operator takes and returns DataFrames; fits collect only bounded
statistics (one number per column, category or partition) and transforms are
plain projections, joins or grouped Arrow kernels that run on executors.
"""

__version__ = "0.1.0"
