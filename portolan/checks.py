"""The statements of the ``dq_sql_checks`` query, over the test tables."""

# (statement, expected): passes only where the result is the expected value itself.
SQL_CHECKS = [
    ("SELECT count(*) FROM part WHERE p_partkey IS NULL", 0),
    ("SELECT count(*) FROM part WHERE p_size > 0", 0),
    ("SELECT CAST(0.5 AS DOUBLE) FROM part WHERE p_partkey = 1", 0),
    ("SELECT CAST(count(DISTINCT p_brand) AS DOUBLE) / 4 AS half, 1 AS half FROM part", 6.25),
    ("SELECT min(p_brand) FROM part", "Brand#1"),
    ("SELECT min(p_type) FROM part", 0),
    ("SELECT CAST(NULL AS INT) FROM part WHERE p_partkey = 1", 0),
    ("SELECT max(p_size) FROM part WHERE p_partkey < 0", None),
    ("SELECT p_size FROM part WHERE p_partkey < 0", 0),
    ("SELECT p_size FROM part WHERE p_partkey < 0", None),
]
