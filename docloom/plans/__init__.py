"""Jobs made of operators: the document table, sync batches, rebuilds, maintenance and status."""
