"""Record linkage and reconciliation as Spark DataFrame operators.

Every public function takes DataFrames (or Columns) plus parameters and returns
a DataFrame (or Column); nothing is collected to the driver and no function
reads the clock.
"""
