"""Missing-value rules as Column expressions.

Blank text means missing; missing compares as a value of its own; n-ary sums and
maxima skip missing, plain arithmetic propagates it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Text that is empty or only spaces becomes NULL; other text stays as it is."""
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def normalise_blanks(df: DataFrame) -> DataFrame:
    """Apply :func:`blank_to_null` to every text column of a source."""
    return df.select(
        *[
            blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def present(c: Column | str) -> Column:
    """True when the text is neither NULL nor blank; never NULL."""
    return F.coalesce(F.trim(_col(c)) != "", F.lit(False))


def first_nonblank(*cols: Column | str) -> Column:
    """The first argument that is present."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def not_equal(c: Column | str, value) -> Column:
    """Inequality that is true for a missing left side when ``value`` is not missing."""
    return ~_col(c).eqNullSafe(value)


def null_sum(*cols: Column | str) -> Column:
    """Sum that skips missing arguments; missing only when all are."""
    cols = [_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])
    return F.when(any_present(*cols), total)


def any_present(*cols: Column | str) -> Column:
    """True when at least one argument is not NULL."""
    return reduce(lambda a, b: a | b, [_col(c).isNotNull() for c in cols])


def null_max(*cols: Column | str) -> Column:
    """Largest argument, skipping missing ones."""
    return F.greatest(*[_col(c) for c in cols])


def fill_default(c: Column | str, default) -> Column:
    """Replace a missing (or blank, for text defaults) value."""
    c = _col(c)
    return F.coalesce(blank_to_null(c) if isinstance(default, str) else c, F.lit(default))


def placeholder_key(c: Column | str, placeholder: str) -> Column:
    """Join key in which a blank becomes a placeholder code."""
    return F.coalesce(blank_to_null(c), F.lit(placeholder))


def presence_flag(c: Column | str) -> Column:
    """'Y' when the joined row exists (its key is present), else 'N'."""
    return F.when(_col(c).isNotNull(), "Y").otherwise("N")


def three_way_flag(yes: Column, no: Column) -> Column:
    """'Y', 'N' or missing when neither condition holds."""
    return F.when(yes, "Y").when(no, "N")
