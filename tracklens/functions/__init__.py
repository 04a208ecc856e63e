"""Column expressions: everything here stays in the JVM."""

from tracklens.functions.arrays import excerpt, excerpt_bounds
from tracklens.functions.dates import run_date, today
from tracklens.functions.flags import at_least_flag, duration_verdict, words_verdict
from tracklens.functions.text import tokens

__all__ = [
    "at_least_flag",
    "duration_verdict",
    "excerpt",
    "excerpt_bounds",
    "run_date",
    "today",
    "tokens",
    "words_verdict",
]
