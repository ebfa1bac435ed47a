"""Ad-spot response analytics as Spark DataFrame jobs."""
