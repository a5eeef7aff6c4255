"""Statistical cubes to analytic tables, as Spark DataFrame jobs."""
