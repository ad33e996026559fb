"""Training-data operators: toxicity, packing, archives, fingerprints, language models, deduplication.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` and the
entry module register its queries when it is present.
"""
