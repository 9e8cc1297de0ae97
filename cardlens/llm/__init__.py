"""Training-data operators: archives, token counts, byte-level encoding and packing, near duplicates,
decontamination, license and toxicity scans, sharding, fingerprints, hard negatives, spelling variants.

Nothing outside this folder (but the guarded block in ``__spark_entry__.py`` and
``corpus_pipeline.py``) imports it.
"""
