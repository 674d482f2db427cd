"""WARC archives: written as records, read back in blocks, verified as a chain from the start of each file.

The line ``WARC/1.1`` may also stand inside a payload. Each scan block lists its candidate records with the
offset of their successor (from Content-Length), and follows them to the first offset beyond the block.
Pointer jumping over these few offsets, from offset 0 of each file, finds where the true chain enters each
block; a second scan walks the blocks from there. Magic that the chain never meets is payload.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfsense.operators.spread import spread_join
from shelfsense.sources.session import SMALL_SIDE_ROWS, stored

MAGIC = "WARC/1.1\r\n"
LEAST_REVISIT = 1000
WRITTEN = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"
# Names of the standard, and one extension field that gives a revisit's full payload size.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SIZE_FIELD = "WARC-Payload-Bytes"
_URN = "urn:page:"


# --- writing ----------------------------------------------------------------------------------------------------

def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``record``: the WARC record of each page, without the two line ends that close it.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest id is a response and the
    others revisit it (rows that repeat that id are responses as well); a null id is the smallest. Null html is
    an empty payload; a null url leaves out its field; line ends in a url are escaped.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("bytes"), F.sha1(F.col("payload").cast("binary")).alias("digest")
    )
    again = stored(
        rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL").drop("n"),
        "payload-groups",
    )
    # payloads stay where they are while the list of repeated ones is small, by count
    joined = rows.join(F.broadcast(again), "digest", "left") if again.count() <= SMALL_SIDE_ROWS else spread_join(rows, again, ["digest"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")) & (F.col("bytes") >= least)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_END)
    )
    typed = joined.withColumn("revisit", revisit).withColumn("block", F.when(F.col("revisit"), http).otherwise(F.concat(http, "payload")))
    urn = lambda c: F.concat(F.lit(f"<{_URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    only = lambda c: F.when(F.col("revisit"), c)
    return typed.select(
        F.concat(
            F.lit(MAGIC),
            _field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
            _field("WARC-Record-ID", urn(F.col("id"))),
            F.lit(f"WARC-Date: {WRITTEN}\r\n"),
            _field("WARC-Target-URI", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")),
            _field("WARC-Profile", only(F.lit(_PROFILE))),
            _field("WARC-Refers-To", only(urn(F.col("first")))),
            _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            _field(_SIZE_FIELD, F.col("bytes").cast("string")),
            F.lit("Content-Type: application/http;msgtype=response\r\n"),
            F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(_END),
            F.col("block"),
        ).alias("record")
    )


def write_archives(records: DataFrame, path: str) -> None:
    """WARC files, uncompressed, one per task; the text writer's line separator closes each record."""
    records.select("record").write.option("lineSep", _END).text(path)


# --- reading ------------------------------------------------------------------------------------------------------

def _header(segment: bytes) -> tuple[dict[str, str], int] | None:
    """Fields of a record that starts here and the bytes up to its block, or None."""
    head, gap, _ = segment.partition(b"\r\n\r\n")
    if not gap:
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields.setdefault(name.strip().lower(), value.strip())
    if "warc-type" not in fields or not fields.get("content-length", "").isdecimal():
        return None
    return fields, len(MAGIC) + len(head) + 4


def _length(segment: bytes) -> int:
    """Bytes from a candidate's magic to its successor, or 0."""
    found = _header(segment)
    return found[1] + int(found[0]["content-length"]) + 4 if found else 0


class _Places:
    """Offsets of the segments of a block, counted from the block's first."""

    def __init__(self) -> None:
        self.block, self.at = None, 0

    def next(self, block: tuple, segment: bytes) -> tuple[int, bool]:
        """The segment's offset, and whether magic stands before it (not so at a file's first byte)."""
        first = block != self.block
        if first:
            self.block, self.at = block, 0
        start, marked = self.at, not (first and block[1] == 0)
        self.at += len(segment) + len(MAGIC) * marked
        return start, marked


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: its bytes, and for each candidate the first offset outside and the last record inside."""
    places, block, listed = _Places(), None, {}
    names = ["file", "block", "bytes", "at", "leaves", "last"]

    def finish() -> pa.RecordBatch:
        out, rows = {}, []
        for at in sorted(listed, reverse=True):
            to = at + listed[at]
            if to in listed:
                out[at] = out.get(to)
            elif to >= places.at and listed[at]:
                out[at] = (to, at)
            if out.get(at):
                rows.append((*block, places.at, at, *out[at]))
        rows.append((*block, places.at, -1, -1, -1))  # so that a block without candidates counts
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    for batch in batches:
        for file, start, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if block is not None and (file, start) != block:
                yield finish()
                listed = {}
            block, segment = (file, start), value.as_buffer().to_pybytes()
            at, marked = places.next(block, segment)
            if marked:
                listed[at] = _length(segment)
    if block is not None:
        yield finish()


_RECORD = "file string, start long, part long, whole boolean, bytes binary"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the chain's entry into each block on; what crosses a block's end comes out in parts.

    A row without a value stands before the segments of its block and holds the chain's entry for them.
    """
    places, block, open_at, ends, parts, chain = _Places(), None, None, None, [], None
    names = ["file", "start", "part", "whole", "bytes"]
    for batch in batches:
        rows: list[tuple] = []

        def close() -> None:
            if parts and open_at is not None:
                text = b"".join(parts)
                rows.append((block[0], open_at, first_part, ends is not None and first_part == open_at and first_part + len(text) >= ends, text))

        for file, start, value, base, entry, before in zip(*(c.to_pylist() for c in batch.columns)):
            if value is None:
                chain = base, entry, before
                continue
            if chain is not None:
                base, entry, before = chain
            if (file, start) != block:
                close()
                block, parts, open_at, ends, first_part = (file, start), [], before, None, base
            at, marked = places.next(block, value)
            at += base
            segment = MAGIC.encode() + value if marked else value
            if at == entry or at == ends:
                close()
                open_at, first_part, parts, ends = at, at, [], at + _length(value)
            parts.append(segment)
        # a record may go on in the next batch, so only its finished forerunners leave now
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    rows = []
    if parts and open_at is not None:
        text = b"".join(parts)
        rows.append((block[0], open_at, first_part, ends is not None and first_part == open_at and first_part + len(text) >= ends, text))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for raw in batch.column(0).to_pylist():
            found = _header(raw[len(MAGIC) :])
            if found is None:
                continue
            fields, begin = found
            block = raw[begin : begin + int(fields["content-length"])]
            _, _, payload = block.partition(b"\r\n\r\n")
            page = fields.get("warc-record-id", "").removeprefix(f"<{_URN}").removesuffix(">")
            refers = fields.get("warc-refers-to", "").removeprefix(f"<{_URN}").removesuffix(">")
            rows.append((
                page or None, fields.get("warc-target-uri"), fields["warc-type"], refers or None,
                fields.get("warc-payload-digest", "").removeprefix("sha1:"), fields.get(_SIZE_FIELD.lower()),
                payload if fields["warc-type"] == "response" else None,
            ))
        columns = list(zip(*rows)) if rows else [[]] * 7
        kinds = [pa.string()] * 6 + [pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["page", "url", "type", "refers", "digest", "size", "payload"]
        )


def _blocks(segments: DataFrame) -> DataFrame:
    """``file, block, base, entry, before``: a row per scan block.

    ``base`` is the offset of its first segment, ``entry`` that of the first record of the chain in it, ``before``
    the record that is open when it starts.
    """
    listed = stored(segments.mapInArrow(_candidates, "file string, block long, bytes long, at long, leaves long, last long"), "candidates")
    in_file = Window.partitionBy("file").orderBy("block")
    based = stored(
        listed.where("at = -1").select("file", "block", "bytes").withColumn("base", F.sum("bytes").over(in_file) - F.col("bytes")),
        "scan-blocks",
    )
    placed = listed.where("at >= 0").join(based.select("file", "block", "base"), ["file", "block"]).select(
        "file", "block", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("leaves")).alias("to"), (F.col("base") + F.col("last")).alias("last")
    )
    targets = placed.select("file", F.col("to").alias("at")).union(placed.select("file", F.lit(0).cast("long").alias("at"))).distinct()
    nodes = stored(placed.join(targets, ["file", "at"], "left_semi"), "chain-nodes")

    # pointer jumping: after k rounds all nodes within 2^k jumps of offset 0 are reached
    jumps = nodes.select("file", "at", "to")
    reached, n = stored(nodes.where("at = 0").select("file", "at"), "reached"), -1
    while (found := reached.count()) != n:
        n = found
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = stored(reached.union(ahead.join(nodes, ["file", "at"], "left_semi")).distinct(), "reached")
        hop = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        jumps = stored(jumps.join(hop, ["file", "to"]).select("file", "at", F.col("far").alias("to")), "jumps")

    entries = nodes.join(reached, ["file", "at"]).groupBy("file", "block").agg(F.min("at").alias("entry"), F.min_by("last", "at").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return based.drop("bytes").join(entries, ["file", "block"], "left").select(
        "file", "block", "base", "entry", F.last("last", ignorenulls=True).over(earlier).alias("before")
    )


def _entered(segments: DataFrame, blocks: DataFrame, max_broadcast: int) -> DataFrame:
    """Segments in scan order with their block's row: sent to all tasks while there are few, else sorted in front of them."""
    if blocks.count() <= max_broadcast:
        return segments.join(F.broadcast(blocks), ["file", "block"]).select("file", "block", "value", "base", "entry", "before")
    placed = segments.withColumn("place", F.monotonically_increasing_id())  # a scan block is read by one task
    heads = blocks.withColumn("place", F.lit(-1).cast("long"))
    rows = placed.unionByName(heads, allowMissingColumns=True).repartition("file", "block").sortWithinPartitions("file", "block", "place")
    return rows.select("file", "block", "value", "base", "entry", "before")


def read_archives(spark: SparkSession, path: str, max_broadcast: int = SMALL_SIDE_ROWS) -> DataFrame:
    """Records of the WARC files in a folder: ``page, url, type, refers, digest, size, payload``.

    Only records on the chain from the start of their file count; the payload is null for revisits. A file
    that does not start with a record has none. The chain's entries, one row per scan block, go to all tasks up to
    ``max_broadcast`` rows; beyond, segments and entries are shuffled by block and sorted.
    """
    lines = spark.read.option("lineSep", MAGIC).text(path)
    segments = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )
    blocks = stored(_blocks(segments), "blocks")
    walked = _entered(segments, blocks, max_broadcast).mapInArrow(_walk, _RECORD)
    whole = walked.where("whole").select("bytes")
    # records cut by a block's end inside their payload, which happens only where a payload holds magic
    cut = (
        walked.where("NOT whole").groupBy("file", "start")
        .agg(F.sort_array(F.collect_list(F.struct("part", "bytes"))).alias("parts"))
        .select(F.aggregate("parts", F.lit("").cast("binary"), lambda all_, p: F.concat(all_, p["bytes"])).alias("bytes"))
    )
    return whole.union(cut).mapInArrow(
        _parsed, "page string, url string, type string, refers string, digest string, size string, payload binary"
    )


def archived_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages below ``path``, read them back: ``id, payload_bytes, payload_digest, record_type, refers_to``.

    Bytes and digest of a response are taken from the payload as read, those of a revisit from its fields. An
    empty table gives an empty result; rows that repeat are records of their own; other columns are not read.
    """
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType
    write_archives(page_records(pages, id_col, url_col, html_col), path)
    read = read_archives(spark, path)
    return read.select(
        F.col("page").cast(kind).alias(id_col),
        F.coalesce(F.octet_length("payload").cast("long"), F.col("size").cast("long")).alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers").cast(kind).alias("refers_to"),
    )
