"""secflow: security analytics (flows, system calls) as Spark DataFrame jobs."""
