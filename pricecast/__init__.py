"""Price-series analytics on Spark: clean, featurise, forecast, evaluate, govern and score panels of bars."""
