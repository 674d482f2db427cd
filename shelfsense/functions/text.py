"""Repair of text that was decoded with the wrong character set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character ISO-8859-1 can hold, and the characters that a UTF-8 lead byte
# (C2..F4) turns into when it is read as ISO-8859-1.
LATIN1_ONLY = r"^[\x00-\xFF]*$"
LEAD_BYTE = r"[Â-ô]"
# The printable characters of Windows-1252 in 80..9F, and the bytes they stand for.
WINDOWS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
WINDOWS_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"


def decode_bytes(raw: Column) -> Column:
    """Bytes to text: UTF-8 where valid, otherwise ISO-8859-1, which accepts any byte."""
    return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(
        F.decode(raw, "ISO-8859-1")
    )


def repair_text(text: Column) -> Column:
    """Undo one round of UTF-8 bytes having been read as ISO-8859-1 or Windows-1252; other text is left alone.

    ``encode`` fails on characters outside the target set, so it only sees text that fits.
    """
    as_bytes = F.translate(text, WINDOWS, WINDOWS_BYTES)
    suspect = as_bytes.rlike(LATIN1_ONLY) & as_bytes.rlike(LEAD_BYTE)
    narrowed = F.encode(F.when(suspect, as_bytes), "ISO-8859-1")
    restored = F.when(F.is_valid_utf8(narrowed.cast("string")), narrowed.cast("string"))
    return F.coalesce(restored, text)


def clean_text(raw: Column) -> Column:
    """Bytes of unknown origin to readable text: decode, then repair."""
    return repair_text(decode_bytes(raw))
