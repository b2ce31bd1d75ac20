"""Imports every module that registers queries."""

from harness import (  # noqa: F401
    contract_queries, document_queries, file_queries, function_queries, job_queries, table_queries,
)
