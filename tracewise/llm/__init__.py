"""Training-data operators: fingerprints, tokenising, quality, chat, packing,
deduplication, URL filters and personal data.  Nothing else in the library
imports this subpackage.

Common rules: every operator reads only the columns it names; helper columns
carry the prefix ``__tw_`` and never clash with extra input columns.  Null
texts count as empty, rows with a null id are passed through unlinked."""
