"""greenwave: traffic-signal performance analytics written as Spark DataFrame jobs."""
