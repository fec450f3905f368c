"""Table and file readers, the table sink, and sample views over benchmark tables."""
