"""Spark jobs that keep a CRM in step with a lease and loan ledger."""
