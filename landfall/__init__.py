"""Landing, expanding, guarding, publishing and reconciling dated batches of nested records on Spark."""
