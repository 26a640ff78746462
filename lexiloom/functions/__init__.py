"""Column functions: text, hashing, templates, parsing, validation, judgements, data-quality contracts."""
