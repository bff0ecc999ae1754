"""tabforge — tabular regression analytics as Spark jobs.

Layout:
  sources/    scans, sinks, report writers, standard frames over the test tables
  functions/  column expressions (null-safe sums, flags, codes, power transform)
              and distributed exact quantiles
  operators/  audit statistics, cleaning, features, encoders, KNN imputation,
              linear models from Gram sums, tree models, validation, ensembles
  plans/      end-to-end pipelines (house preset, ablation) and the query catalogue
  streaming/  nothing: the workload is batch only
"""

from tabforge.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
