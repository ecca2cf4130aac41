"""Training-data operators: fingerprints, near-duplicate joins, secret scans,
exact substring removal, chat repair, mixing, WARC archives, benchmark
decontamination, URL filters and toxicity scores.

Nothing outside this package (and the top-level corpus pipeline) imports it.
"""
