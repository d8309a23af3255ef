"""tallycast: continuous evaluation of probabilistic forecasts as Spark jobs."""
