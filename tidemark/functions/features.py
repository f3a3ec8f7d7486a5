"""What a model may see: the title and the summary of an article, nothing else."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.python import OPENING, to_text

# The fields that features may be made of. All others tell the label, the publisher or the future.
ALLOWED = ("title", "summary")
VERSION = 1


class ForbiddenField(ValueError):
    pass


def guarded(df: DataFrame, *fields: str) -> DataFrame:
    """The fields of df, or ForbiddenField where one is not to be learned from."""
    bad = [f for f in fields if f not in ALLOWED]
    if bad:
        raise ForbiddenField(f"not a feature: {', '.join(bad)}")
    return df.select(*fields)


def text() -> Column:
    """The one text of an article that models see."""
    return to_text(F.col("title"), F.coalesce("summary", F.lit("")))


def feature_hash() -> str:
    """Changes whenever the fields, the text rule or its version do; models are saved and loaded with it."""
    return hashlib.sha256(json.dumps([VERSION, ALLOWED, OPENING.pattern, "NFKC"]).encode()).hexdigest()[:16]
