from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*fields: Column | str) -> Column:
    """Hex digest of the fields' text, NULL counting as empty text."""
    columns = [F.col(f) if isinstance(f, str) else f for f in fields]
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("||", *parts))


def normalized_name(name: Column) -> Column:
    """The form under which sponsor names of the two registries are compared."""
    return F.upper(F.trim(name))
