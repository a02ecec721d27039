"""Training-data operators: language id, decontamination, PII, dedup, quality, token files, BPE, licences.

Nothing outside this folder imports it; ``corpus_pipeline.py`` and the entry module use it.
"""
