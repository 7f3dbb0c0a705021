"""Operators of a training-data pipeline: quality rules, a quality classifier,
near-duplicate groups, a language model, byte-pair encoding, secret and
personal-data scans, sequence packing, exact vector search and substring
removal. Nothing outside this subpackage imports it."""
