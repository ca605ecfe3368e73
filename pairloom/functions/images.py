"""Image payload helpers: base64, MIME sniffing, data URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Supported extensions and the leading bytes of each format.
EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".webp")
SIGNATURES = (
    ("89504E47", "", "image/png"),
    ("FFD8", "", "image/jpeg"),
    ("52494646", "57454250", "image/webp"),
    ("424D", "", "image/bmp"),
)
FALLBACK_MIME = "image/jpeg"
# Whole groups of four, the last one perhaps padded; what follows a pad is not read.
_BASE64 = r"\A(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=|\z)"


def encode_image(content: Column) -> Column:
    """Bytes to one-line base64 (Spark's own output may be chunked)."""
    return F.translate(F.base64(content), "\r\n", "")


def extension(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/]*)\z", 1)
    return F.lower(F.regexp_extract(name, r"\A\.*[^.].*(\.[^.]+)\z", 1))


def is_image_path(path: Column) -> Column:
    return extension(path).isin(*EXTENSIONS)


def mime_type(b64: Column) -> Column:
    """Sniff the type from the first 64 base64 characters."""
    # unreadable base64 falls back as well
    head = F.hex(F.try_to_binary(F.substring(b64, 1, 64), F.lit("base64")))
    guess = F.lit(FALLBACK_MIME)
    for lead, inner, mime in reversed(SIGNATURES):
        hit = head.startswith(lead)
        if inner:
            # hex digits come in pairs, so an odd position is not a byte match
            hit = hit & F.substring(head, 1, 32).rlike(f"^(?:..)*?{inner}")
        guess = F.when(hit, F.lit(mime)).otherwise(guess)
    return guess


def data_url(b64: Column) -> Column:
    return F.concat(F.lit("data:"), mime_type(b64), F.lit(";base64,"), b64)


def parse_data_url(url: Column) -> Column:
    """Base64 part of ``data:image/..,<b64>``; anything else is an error.

    The first 128 characters must be readable; signs outside the alphabet are
    passed over.
    """
    b64 = F.get(F.split(url, ",", 2), F.lit(1))
    head = F.regexp_replace(F.substring(b64, 1, 128), "[^A-Za-z0-9+/=]", "")
    good = url.startswith("data:image/") & head.rlike(_BASE64)
    return F.when(good, b64).otherwise(F.raise_error(F.lit("Invalid uploaded picture: not a data URL with a readable image")))


def content_hash(b64: Column) -> Column:
    return F.sha2(b64, 256)
