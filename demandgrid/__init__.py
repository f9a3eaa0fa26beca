"""Station-hour demand panels, features, models and scoring as Spark DataFrame plans."""
