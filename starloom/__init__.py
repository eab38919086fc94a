"""starloom: raw extracts to an audited star schema and its metrics, as Spark plans."""
