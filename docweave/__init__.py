"""docweave: document and customer-comment analytics as Spark DataFrame jobs."""
