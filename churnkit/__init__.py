"""Customer-churn analytics on Spark: cleaning, features, scoring, star schema and streams."""
