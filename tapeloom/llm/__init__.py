"""Operators for training-data pipelines: WARC, quality, chat, decontamination, dedup, packing ..."""
