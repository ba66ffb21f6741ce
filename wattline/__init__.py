"""wattline: utility-meter analytics written as Spark DataFrame jobs."""
