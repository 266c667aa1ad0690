"""Reading and writing: landing files, batch tables, the ledger, the catalog, the fixture."""
