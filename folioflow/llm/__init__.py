"""Training-data operators: dedup, extraction, language, toxicity, secrets, decontamination, mixing, token files."""
