"""DuckDB statements that state the expected result of each registered query.

One generator turns the rules of :mod:`.rules` (what each load moves) into statements
with key maps as named sub-selects, NOT EXISTS and DISTINCT ON; they share no code with
the Spark plans beyond the declared tables and run on
the driver's raw test tables (views ``region``, ``nation``, ``customer`` ...).
"""

from .checks import check_statements
from .operators import operator_statements
from .sql import oracle_statements

__all__ = ["check_statements", "operator_statements", "oracle_statements"]
