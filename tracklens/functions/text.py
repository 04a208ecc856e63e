from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklens.constants import SPACE_PATTERN


def tokens(text: Column) -> Column:
    """Lower-cased words of ``text``; punctuation stays on its word.

    Splitting is cheaper than collecting matches of a word pattern. White space
    at either end leaves an empty string there, which is taken out.
    """
    return F.array_remove(F.split(F.lower(text), SPACE_PATTERN), "")
