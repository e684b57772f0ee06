"""Training-data operators: search, quality, dedup, safety, token accounting,
tokenisation, decontamination and URL rules. One module per operator; the
registered queries are in ``queries``."""
