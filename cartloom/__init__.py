"""Session-commerce analytics and recommendation, written as Spark DataFrame jobs."""
