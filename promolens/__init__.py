"""promolens: incentive extraction, ranking and evaluation as Spark plans."""
