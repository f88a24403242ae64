"""Training-data operators: tokenising, scanning, scoring, deduplication,
decontamination and formatting of text corpora. Nothing outside this
subpackage imports it."""
