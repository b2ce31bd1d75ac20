"""DataFrame operators: flatten, de-duplicate, validate, reference checks, upsert, work lists, reports."""
