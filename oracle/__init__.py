"""DuckDB oracle SQL for the driver's correctness gate.

Written independently of the DataFrame code: only the fixture view texts
(FIXTURES.md section B) are shared.
"""
