"""Multi-step plans: ingestion, star schema and analytics."""
