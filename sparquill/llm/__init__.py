"""Training-data operators: packing, toxicity, near-dedup, token counts, quality,
suffix dedup, PII, secret scans, SimHash and decontamination.

Nothing outside this subpackage imports it.
"""
