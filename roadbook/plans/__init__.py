"""The gold tables, the queries on them, the dashboard datasets and the job that builds them."""
