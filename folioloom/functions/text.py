"""Text, digest and id expressions. All of them run inside the JVM but ``hash64_blake2b``."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.strip() removes.
BLANKS = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Preview length in code points, year of an undated document.
PREVIEW_CHARS = 1024
UNKNOWN_YEAR = 9999


def norm_text(text: Column) -> Column:
    """CRLF to LF, outer blanks off, null to the empty string."""
    unix = F.replace(F.coalesce(text, F.lit("")), F.lit("\r\n"), F.lit("\n"))
    return F.btrim(unix, F.lit(BLANKS))


def content_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def text_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def document_id(ia_id: Column, text: Column, source_uri: Column) -> Column:
    """The given id, or a digest of text and origin where it is missing or empty."""
    fallback = content_digest(F.concat(text, F.coalesce(source_uri, F.lit(""))))
    return F.coalesce(F.nullif(ia_id, F.lit("")), fallback)


def blob_uri(digest: Column) -> Column:
    return F.concat(
        F.lit("blob://sha256/"), F.substring(digest, 1, 2), F.lit("/"),
        F.substring(digest, 3, 2), F.lit("/"), digest,
    )


def preview(text: Column) -> Column:
    return F.left(text, F.lit(PREVIEW_CHARS))


def year_or_unknown(year: Column) -> Column:
    """Lenient cast to INT; null, zero and values that do not cast become the unknown year."""
    return F.coalesce(F.nullif(year.try_cast("int"), F.lit(0)), F.lit(UNKNOWN_YEAR))


def prefixed(text: Column, role: str) -> Column:
    """Role marker in front of a text to embed: ``passage`` or ``query``."""
    return F.concat(F.lit(f"{role}: "), text)


def hash64(key: Column) -> Column:
    """60-bit id of any string, stable over runs and engines."""
    return F.conv(F.substring(content_digest(key), 1, 15), 16, 10).cast("bigint")


def hash64_blake2b(key: Column) -> Column:
    """Little-endian signed 8-byte BLAKE2b id, for indexes keyed that way elsewhere."""

    def digest(keys: pa.Array) -> pa.Array:
        return pa.array(
            [None if k is None else int.from_bytes(
                hashlib.blake2b(k.encode(), digest_size=8).digest(), "little", signed=True)
             for k in keys.to_pylist()],
            pa.int64(),
        )

    return F.arrow_udf(digest, "bigint")(key)
