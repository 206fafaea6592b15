"""Daily market prices and dated reports to model-ready text datasets, on Spark."""
