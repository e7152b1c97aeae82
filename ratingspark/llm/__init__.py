"""Training-data pipeline operators (packing, deduplication, toxicity, chat
formatting, archives, mixing, fingerprints). One module per operator; the
registered queries are in ``queries``. Nothing outside this subpackage
imports it, except the entry point and ``corpus_pipeline``."""
