"""Text cleaning as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasemill.model import STRIP_CHARS
from releasemill.sources import devicexml

# --- fixed values: same sets as the document parser, in Java syntax ----------
ILLEGAL_CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
BARE_AMPERSAND = r"&(?!(?:amp|lt|gt|quot|apos|#\p{Nd}+|#x[0-9a-fA-F]+);)"


def _decode_other(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else devicexml.decode_charset(bytes(b)))


def decode_charset(data: Column) -> Column:
    """Bytes to text: UTF-8, else GBK, else UTF-8 without its bad bytes.

    Valid UTF-8 stays in the JVM; Python only sees the other payloads.  `data` is
    looked at more than once, so let it be a column of its own rather than a formula.
    """
    valid = F.try_validate_utf8(data.cast("string"))
    # Made here: once used it holds a Java object, and this module travels to tasks.
    decode_other = F.pandas_udf(_decode_other, T.StringType())
    return F.coalesce(valid, decode_other(F.when(valid.isNull(), data)))


def strip_controls(text: Column) -> Column:
    return F.regexp_replace(text, ILLEGAL_CONTROLS, "")


def replace_nbsp(text: Column) -> Column:
    return F.replace(text, F.lit("&nbsp;"), F.lit(" "))


def escape_ampersands(text: Column) -> Column:
    return F.regexp_replace(text, BARE_AMPERSAND, "&amp;")


def clean_text(text: Column) -> Column:
    return escape_ampersands(replace_nbsp(strip_controls(text)))


def drop_encoding(text: Column) -> Column:
    """Remove a charset from the XML declaration: the text is already decoded."""
    return F.regexp_replace(
        text, r"""^(﻿?\s*<\?xml[^>]*?)\s+encoding\s*=\s*(?:"[^"]*"|'[^']*')""", "$1"
    )


def local_name(tag: Column) -> Column:
    """Tag without its `{namespace}`."""
    return F.substring_index(tag, "}", -1)


def strip_text(text: Column) -> Column:
    """Both ends without Unicode white space; missing becomes empty."""
    return F.coalesce(F.btrim(text, F.lit(STRIP_CHARS)), F.lit(""))
