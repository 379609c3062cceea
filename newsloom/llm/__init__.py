"""Operations of a training-data pipeline: deduplication, filters, search, mixing, packing."""
