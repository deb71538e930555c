"""End-to-end plans: features, documents, export, the job, the query catalog."""
