"""Training-data operators: language, URL, quality, duplicates, extraction, search, mixing and packing."""
