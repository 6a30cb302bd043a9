"""Used-vehicle listings and emission-rule analytics as Spark DataFrame jobs."""
