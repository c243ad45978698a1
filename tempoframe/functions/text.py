"""Text functions that have no built-in form."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.udf(StringType(), useArrow=False)
def normalize_name(name: str | None) -> str | None:
    """Letters without marks in lower case, runs of anything but a-z and 0-9 as one space, trimmed; null stays null.

    Texts may be long, so rows go to Python a hundred at a time and not in Arrow batches of thousands.
    """
    if name is None:
        return None
    apart = unicodedata.normalize("NFKD", name)
    bare = "".join(c for c in apart if not unicodedata.combining(c)).casefold()
    return re.sub("[^a-z0-9]+", " ", bare).strip()
