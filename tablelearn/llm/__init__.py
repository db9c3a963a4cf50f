"""Training-data operators: fingerprints, language ID, deduplication, packing,
token rollups, decontamination and classifiers. Nothing else in the library
imports this subpackage; ``__spark_entry__`` registers its queries when present."""
