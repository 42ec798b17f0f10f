"""The test tables in this library's record shapes, the registered queries, and their SQL oracles."""
