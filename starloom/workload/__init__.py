"""The test tables as a raw retail feed, the registered queries and their SQL twins."""
