"""Row operators: admission, descriptor checks, bronze, mapping, dedup, audit."""
