"""Training-data operators on Spark DataFrames.

Thirteen operators (mixing, near-duplicate removal, resharding, toxicity, quality
rules, token-id files, nearest neighbours, line dedup, token counts, BPE round trip,
quality classifier, spelling variants, source divergence). Nothing outside this
subpackage imports it.
"""
