"""Feature, quality and merge operators: DataFrame in, DataFrame out."""
