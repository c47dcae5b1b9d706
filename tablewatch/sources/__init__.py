"""Sources: catalog/path tables, CSV with external schema, rule tables, write statistics."""
