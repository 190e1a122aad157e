"""Training-data operators: joins, dedup, decontamination, token files, sharding,
packing, scoring. Nothing else in the library imports this subpackage; the
queries it registers live in :mod:`livepulse.llm.queries`."""
