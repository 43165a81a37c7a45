"""DataFrame -> DataFrame operators: cleaning, dedup, ordering, batching,
tokenizer training and encoding, packing, scoring, run-log analytics."""
