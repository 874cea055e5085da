"""Training-data operators: mixing, scoring, dedup, formatting, filtering, decontamination."""
