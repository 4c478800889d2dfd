"""Training-data operators: scoring, near-duplicates, decontamination, packing, archives."""
