"""Vehicle sales and promotion-cost marts as composable Spark DataFrame operators."""
