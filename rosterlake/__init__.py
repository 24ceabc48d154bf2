"""HR, payroll and leave analytics as Spark DataFrame jobs."""
