"""The query catalogue: every operator run over the given tables, with the SQL it must equal."""
