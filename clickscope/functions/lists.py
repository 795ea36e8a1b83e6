"""Comma-list handling with the JVM ``String.split`` rule.

``String.split(sep)`` on the JVM drops *trailing* empty pieces, while
Spark's ``split`` keeps them:

    '1,2,,' -> [1, 2]        (Spark: [1, 2, '', ''])
    ''      -> ['']          (one empty piece)
    ',1'    -> ['', '1']     (leading empties are kept)
    ','     -> []            (only separators: nothing)
    null    -> null          (the row has no list)

Pieces are not trimmed. The rule is: a string made only of separators is
empty; otherwise strip the trailing separators and split.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def jvm_split(col: Column | str, sep: str = ",") -> Column:
    """Split ``col`` on the literal ``sep`` the way the JVM does."""
    c = F.col(col) if isinstance(col, str) else col
    s = re.escape(sep)
    only_seps = c.rlike(f"^(?:{s})+$")
    stripped = F.regexp_replace(c, f"(?:{s})+$", "")
    # Only a string ending in the separator differs from Spark's split, so
    # the common case skips both regular expressions.
    return (F.when(c.isNull(), F.lit(None).cast("array<string>"))
            .when(~c.endswith(F.lit(sep)), F.split(c, s))
            .when(only_seps, F.array().cast("array<string>"))
            .otherwise(F.split(stripped, s)))
