"""Instruction-data preparation and training-run analytics as Spark jobs.

Every public function takes and returns DataFrames or Columns, so it can be
chained with ``df.transform`` and planned by Catalyst as one query.
"""
