"""Product and review analytics for marketplaces, written as Spark DataFrame operators."""
