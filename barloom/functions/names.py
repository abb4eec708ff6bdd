"""Symbol names: folder group, percent-encoding, ticker suffixes, source keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes the exchange appends to tickers in minute files.
EQUITY_SUFFIX = r"(\.NC)?\.NSE$"
INDEX_SUFFIX = r"\.NSE_IDX$"
# Header names of the raw files that are reserved words.
HEADER_KEYWORDS = ("close",)


def symbol_group(symbol: Column) -> Column:
    first = F.lower(F.substring(symbol, 1, 1))
    return F.when(first.rlike("^[a-z0-9]$"), first).otherwise(F.lit("_"))


def encode_symbol(symbol: Column) -> Column:
    """Percent-encode all but letters, digits and `-_.~&()`, blanks as `%20`."""
    form = F.url_encode(symbol)
    for written, wanted in (("+", "%20"), ("%26", "&"), ("%28", "("), ("%29", ")"), ("%7E", "~"), ("*", "%2A")):
        form = F.replace(form, F.lit(written), F.lit(wanted))
    return form


def decode_symbol(name: Column) -> Column:
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def strip_ticker(ticker: Column, suffix: str = EQUITY_SUFFIX) -> Column:
    return F.regexp_replace(F.trim(ticker), suffix, "")


def source_key(kind: str | Column, name: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(kind, F.lit(":"), name)


def cache_id(path: Column) -> Column:
    return F.sha1(path)


def contains_text(symbol: Column, needle: str) -> Column:
    """Case-insensitive substring search, blanks around the search text ignored."""
    return F.contains(F.upper(symbol), F.upper(F.trim(F.lit(needle))))


def content_prefix(version: int) -> bytes:
    """What a content fingerprint hashes before the file's bytes."""
    return f"adapter:{version}\0".encode()


def content_fingerprint(version: Column, content: Column) -> Column:
    """sha256 over `adapter:<version>`, a zero byte, and the file's bytes."""
    prefix = F.encode(F.concat(F.lit("adapter:"), version.cast("string")), "utf-8")
    return F.sha2(F.concat(prefix, F.unhex(F.lit("00")), content), 256)


def stat_fingerprint(version: Column, length: Column, modified: Column) -> Column:
    """sha256 over `v<version>:<size>:<modification time in ns>`."""
    nanos = F.unix_micros(modified) * F.lit(1000)
    text = F.concat(F.lit("v"), F.concat_ws(":", version.cast("string"), length.cast("string"), nanos.cast("string")))
    return F.sha2(text, 256)


def normalized_name(raw: Column) -> Column:
    """Raw header to column name: `' DELIV_QTY'` -> `deliv_qty`, `'Change(%)'` -> `change`.

    Lower case, blanks to underscores, other signs dropped; SQL keywords and names
    that begin with a digit get a leading underscore.
    """
    kept = F.regexp_replace(F.lower(F.trim(raw)), r"[^0-9a-z_\s]", "")
    name = F.regexp_replace(F.trim(kept), r"\s+", "_")
    return F.when(name.isin(*HEADER_KEYWORDS) | name.rlike("^[0-9]"), F.concat(F.lit("_"), name)).otherwise(name)
