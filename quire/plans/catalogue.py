"""All queries of the core by name, with the SQL that must give the same rows."""

from __future__ import annotations

from quire.plans import problems, problems_sql, reference, reference2, reference2_sql, reference3, reference3_sql, reference4, reference4_sql, reference5, reference5_sql, reference6, reference6_sql, reference7, reference7_sql, reference8, reference8_sql, reference_sql

FLAGSHIP = "run_health"


def queries() -> dict:
    return {**problems.QUERIES, **reference.QUERIES, **reference2.QUERIES, **reference3.QUERIES, **reference4.QUERIES, **reference5.QUERIES, **reference6.QUERIES, **reference7.QUERIES, **reference8.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**problems_sql.SQL, **reference_sql.SQL, **reference2_sql.SQL, **reference3_sql.SQL, **reference4_sql.SQL, **reference5_sql.SQL, **reference6_sql.SQL, **reference7_sql.SQL, **reference8_sql.SQL}
