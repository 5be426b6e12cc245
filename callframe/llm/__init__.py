"""Training-data operators: token counts, deduplication, packing,
fingerprints, language and toxicity filters, encoding, binary output and
language-model scoring. Nothing else in the package imports this one."""
