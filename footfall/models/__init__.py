"""Feature preparation, distributed learners, scoring and attribution on Spark ML."""
