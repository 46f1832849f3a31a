"""Training-data operators: cleaning, dedup, decontamination, tokens, shards, archives.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
