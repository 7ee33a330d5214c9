"""Training-data operators: quality, packing, line dedup, secrets, BPE, repetition, PII, SimHash, language ID, top-k search, sharding,
click dedup, filter audit."""
