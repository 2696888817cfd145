"""Training-data operators: packing, deduplication, decontamination, tokens, text extraction, quality."""
