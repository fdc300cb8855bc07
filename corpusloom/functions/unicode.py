"""Unicode normal forms and byte decoding, which Spark's own functions do not offer.

Each is an Arrow-batched UDF over whole columns; ASCII text is passed through untouched.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from corpusloom.functions.text import whitespace_tokens

BYTES_AT_ONCE = 1 << 20


def _each(values: pa.Array, fn: Callable, ready: Callable[[pa.Array], pa.Array] | None = None) -> pa.Array:
    """``fn`` of every value but those that are ``ready`` or NULL; Python holds some million bytes of them at a time."""
    parts = []
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    for _, rows in groupby((np.cumsum(sizes) // BYTES_AT_ONCE).tolist()):
        part = values.slice(at, sum(1 for _ in rows))
        at += len(part)
        if ready is not None and pc.all(ready(part), min_count=0).as_py():
            parts.append(part)
        else:
            parts.append(pa.array([None if v is None else fn(v) for v in part.to_pylist()], pa.string()))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _plain(text: str) -> str:
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@arrow_udf(StringType())
def _nfd(texts: pa.Array) -> pa.Array:
    return _each(texts, lambda t: t if t.isascii() else unicodedata.normalize("NFD", t), pc.string_is_ascii)


@arrow_udf(StringType())
def _nfkd_without_marks(texts: pa.Array) -> pa.Array:
    return _each(texts, _plain, pc.string_is_ascii)


@arrow_udf(StringType())
def _decode(raw: pa.Array) -> pa.Array:
    return _each(raw, lambda b: b.decode("utf-8", "ignore"))


def strip_accents(col: Column) -> Column:
    """Lower-case, decompose, and drop non-spacing marks."""
    return F.regexp_replace(_nfd(F.lower(col)), r"\p{Mn}", "")


def normalize_text(col: Column, lower: bool = False, keep_accents: bool = False) -> Column:
    """Squeeze whitespace, unify quotes, take the compatibility form without combining marks."""
    out = F.array_join(whitespace_tokens(col), " ")
    out = F.regexp_replace(out, "``|''", '"')
    if not keep_accents:
        out = _nfkd_without_marks(out)
    return F.lower(out) if lower else out


def decode_utf8(col: Column) -> Column:
    """Text of a binary column; byte sequences that are not UTF-8 are left out."""
    return _decode(col)
