"""The operators and pipelines over the supplied tables, each with its SQL equivalent."""
