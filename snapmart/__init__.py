"""snapmart: snapshot history, star schema, daily marts and data checks as Spark jobs."""
