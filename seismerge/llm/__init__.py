"""Training-data operators: URL filters, language ID, LM scoring,
decontamination, packing, near and exact dedup, long-repeat removal, token
counts and quality scoring. Nothing outside this subpackage imports it."""
