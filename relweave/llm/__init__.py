"""Operations of a training-data pipeline over the corpus tables, one module each."""
