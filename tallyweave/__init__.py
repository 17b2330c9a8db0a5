"""Review, basket, similarity and recommendation analytics as Spark DataFrame jobs."""
