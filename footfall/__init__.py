"""footfall: weekly retail purchase propensity as plain Spark DataFrame operators."""
