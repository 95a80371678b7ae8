"""Training-data operators: deduplication, quality, toxicity, tokenisation, language models, mixing.

Nothing outside this subpackage imports it; the driver entry file adds its queries when it is present.
"""
