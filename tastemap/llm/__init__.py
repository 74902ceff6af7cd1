"""Operators for preparing training corpora: deduplication, filtering, extraction,
search, mixing and packing, each over whole tables with Spark."""
