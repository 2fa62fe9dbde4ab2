"""Training-data operators (quality, dedup, decontamination, mixing, sharding).

Nothing outside this subpackage imports it; ``queries.py`` lists its bindings
and ``corpus_pipeline.py`` at the repository top chains five of them."""
