"""repo_pulse: software-project activity analytics as Spark DataFrame operators.

Raw pull request, issue and review JSON lands in append-only tables; the
operators in this package turn it into typed latest-version entities,
lifecycle metrics, fact tables, a dense daily per-repository mart,
slowly-changing history, quality checks and dashboard queries.
Every operator takes and returns a DataFrame; "today" is always an argument.
"""

__version__ = "0.1.0"
