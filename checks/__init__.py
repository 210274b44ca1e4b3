"""Check queries on feeds derived from the test tables, with their SQL oracles."""
