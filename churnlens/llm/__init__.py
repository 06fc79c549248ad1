"""Training-data pipeline operators: extraction, de-duplication, filtering, mixing, tokenising."""
