"""Operations that a training-data pipeline needs, as Spark jobs."""
