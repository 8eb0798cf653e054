"""All queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from graylane.llm import registry_arrow, registry_native, registry_records

QUERIES = registry_native.QUERIES | registry_arrow.QUERIES | registry_records.QUERIES
ORACLES = registry_native.ORACLES | registry_arrow.ORACLES | registry_records.ORACLES
