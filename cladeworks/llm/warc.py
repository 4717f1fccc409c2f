"""WARC archives: write pages as records, and read archives back by boundary chains.

Archives aren't compressed and have no index. Each task searches a split for record
magic and emits, for every candidate, the offset of its successor. Candidates inside
payloads look the same; pointer jumping from each file's start keeps only what the
chain reaches.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import hash_filter, materialize, may_hold
from .splits import bases, file_sizes, read_lines, splits_of

SPLITS_AT_ONCE = 1 << 20  # 56 MB of what tasks must know of them, for 128 TB in splits of 128 MB
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_MAGIC = re.compile(rb"(?:\A|(?<=\n))WARC/1\.[01]\r\n")
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*\r\n", re.I)
_EDGE = pa.struct([(n, pa.bool_() if n in ("crlf", "blank") else pa.int64()) for n in ("open", "length", "crlf", "blank", "end", "first", "first_end", "once")])


def plan_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Append ``payload, digest, refers_to`` to ``page_id, url, html``.

    Of pages with equal payloads of ``least_bytes`` or more, all but the largest
    page_id refer to it. Null html is an empty payload; a null page_id never refers
    and isn't referred to; rows that repeat the largest page_id are all responses.
    Only rows that a 2 MB filter of the revisits lets pass are joined with them; all
    other payloads stay where they are.
    """
    pages = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    large = pages.filter(F.octet_length("payload") >= least_bytes).filter("page_id IS NOT NULL").select("page_id", "digest")
    kept = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("refers_to <> least").select("digest", "refers_to")
    revisits = materialize(large.join(kept.hint("merge"), "digest").filter("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct())
    shared = pages.sparkSession.sparkContext.broadcast(hash_filter(revisits.select(F.xxhash64("page_id", "digest").alias("h"))))

    @F.arrow_udf("boolean")
    def may_revisit(h: pa.Array) -> pa.Array:
        return pa.array(may_hold(shared.value, h.to_numpy(zero_copy_only=False)))

    pages = pages.withColumn("_may", may_revisit(F.xxhash64("page_id", "digest")))
    alone = pages.filter("NOT _may").withColumn("refers_to", F.lit(None).cast(pages.schema["page_id"].dataType))
    return alone.unionByName(pages.filter("_may").join(revisits.hint("merge"), ["page_id", "digest"], "left")).drop("_may")


def write_warc(pages: DataFrame, path: str, least_bytes: int = 1000, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write a record for each row of ``pages(page_id, url, html)`` below ``path``.

    Records are built and written JVM-side, a file for each task; line breaks in a
    URL are left out. Every row gives a record, repeated page_ids too; other columns are
    ignored; an empty table gives no record. A record must fit a task.
    """
    plan = plan_records(pages, least_bytes)
    revisit = F.col("refers_to").isNotNull()
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", ""), F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.when(revisit, 0).otherwise(F.octet_length("payload") + len(_HTTP)).cast("string"), F.lit("\r\n\r\n"),
        F.when(revisit, "").otherwise(F.concat(F.lit(_HTTP), F.col("payload").cast("string"))), F.lit("\r\n\r"),
    )
    plan.select(record.alias("value")).write.option("lineSep", "\n").text(path)


def _headers(data: bytes) -> Callable[[int], tuple[int, int] | None]:
    """Length of the header at an offset and of its block; None without an end or a length.

    Headers may have any length. Asked for growing offsets; what is found serves all
    offsets up to it, so many candidates before one end cost no more than one.
    """
    end, length, length_end, value = -1, -1, -1, 0  # len(data): there is none from here on

    def header(at: int) -> tuple[int, int] | None:
        nonlocal end, length, length_end, value
        if end < at:
            end = data.find(b"\r\n\r\n", at)
            end = len(data) if end < 0 else end
        if length < at:
            found = _LENGTH.search(data, at)
            length, length_end, value = (found.start(), found.end(), int(found[1])) if found else (len(data), len(data) + 3, 0)
        return (end + 4 - at, value) if end < len(data) and length_end <= end + 2 else None

    return header


def scan_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Per split a row ``kind`` 0 and per candidate record a row ``kind`` 1.

    Of a candidate: offsets from the split's start of itself, of where its chain leaves
    the split, and of the last record before that and its block (all null for a chain
    that breaks inside). Of a split: its size in ``at``, and in ``edge`` what headers
    that cross its ends need: the first candidate without an end (``open``) and the
    length it names so far, whether the split ends in CR LF, and, for a header from
    before, whether a blank line or the rest of a length line may come first (they
    count only behind a split that ends in CR LF), the end of the first blank line,
    and the first length with the place where it ends.
    """

    def run(batches):
        for key, split, data in splits_of(batches):
            starts, nexts, bodies, open_at = [], [], [], None
            header = _headers(data)
            last_end = data.rfind(b"\r\n\r\n")
            for m in _MAGIC.finditer(data):
                at = m.start()
                if found := header(at):
                    starts.append(at)
                    bodies.append(at + found[0])
                    nexts.append(at + found[0] + found[1] + 4)
                elif at > last_end:
                    open_at = at
                    break  # all that follow are open too, and inside this one's header or block
            none, leave = (None, None, None), {}
            for at, to, body in zip(starts[::-1], nexts[::-1], bodies[::-1], strict=True):
                leave[at] = (to, at, body) if to >= (len(data) if open_at is None else open_at) else leave.get(to, none)
            n = len(starts)
            ends = list(zip(*(leave[s] for s in starts), strict=True)) or [(), (), ()]
            own = _LENGTH.search(data, open_at) if open_at is not None else None
            first, after = _LENGTH.search(data), data.find(b"\r\n\r\n")
            at_once = _LENGTH.match(b"\r\n" + data[: data.find(b"\n") + 1])
            edge = {
                "open": open_at, "length": int(own[1]) if own else None, "crlf": data.endswith(b"\r\n"), "blank": data.startswith(b"\r\n"),
                "end": after + 4 if after >= 0 else None, "first": int(first[1]) if first else None, "first_end": first.end() if first else None,
                "once": int(at_once[1]) if at_once else None,
            }
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * (n + 1), pa.int64()), pa.array([split] * (n + 1), pa.int64()), pa.array([0] + [1] * n, pa.int32()),
                    pa.array([len(data), *starts], pa.int64()), *(pa.array([None, *e], pa.int64()) for e in ends),
                    pa.array([edge] + [None] * n, _EDGE),
                ],
                ["file_key", "split", "kind", "at", "leave", "last", "body", "edge"],
            )

    edge = ", ".join(f"{f.name}: {'boolean' if f.type == pa.bool_() else 'long'}" for f in _EDGE)
    return read_lines(spark, path).mapInArrow(run, f"file_key long, split long, kind int, at long, leave long, last long, body long, edge struct<{edge}>")


def _stitched(summary: DataFrame) -> DataFrame:
    """Candidates whose header crosses the end of a split, and of any number of splits."""
    order = Window.partitionBy("file_key").orderBy("split")
    after = order.rowsBetween(1, Window.unboundedFollowing)
    joined = F.coalesce(F.lag("edge.crlf").over(order), F.lit(False))  # the split before ends in CR LF
    end = F.when(joined & F.col("edge.blank"), F.lit(2)).otherwise(F.col("edge.end"))
    once = joined & F.col("edge.once").isNotNull()
    length = F.when(once, F.struct(F.col("base").alias("by"), F.col("edge.once").alias("n")))
    length = length.when(F.col("edge.first").isNotNull(), F.struct((F.col("base") + F.col("edge.first_end")).alias("by"), F.col("edge.first").alias("n")))
    rows = summary.withColumn("end", F.col("base") + end).withColumn("named", length)
    rows = rows.withColumn("body", F.first("end", ignorenulls=True).over(after)).withColumn("next", F.first("named", ignorenulls=True).over(after))
    # A length line ends at the blank line at the latest: two bytes before the block.
    size = F.coalesce("edge.length", F.when(F.col("next.by") <= F.col("body") - 2, F.col("next.n")))
    rows = rows.filter("edge.open IS NOT NULL").select("file_key", "split", (F.col("base") + F.col("edge.open")).alias("at"), "body", size.alias("size"))
    rows = rows.filter("body IS NOT NULL AND size IS NOT NULL")
    return rows.select("file_key", "split", "at", (F.col("body") + F.col("size") + 4).alias("leave"), F.col("at").alias("last"), "body")


def reachable_entries(candidates: DataFrame, max_rounds: int = 48) -> DataFrame:
    """Candidates at which the chain from offset 0 enters a split: ``file_key, at``.

    ``candidates``: ``file_key, at, leave``, absolute. Each round doubles the length
    of the jumps and of the reached part of each chain.
    """
    jump = materialize(candidates.filter("leave IS NOT NULL").select("file_key", "at", F.col("leave").alias("to")))
    reached = candidates.filter("at = 0").select("file_key", "at")
    known = -1
    for _ in range(max_rounds):
        step = reached.join(jump.hint("merge"), ["file_key", "at"]).select("file_key", F.col("to").alias("at"))
        reached = materialize(reached.union(step.join(candidates.hint("merge"), ["file_key", "at"], "left_semi")).distinct())
        if (now := reached.count()) == known:
            break
        known = now
        far = jump.select("file_key", F.col("at").alias("to"), F.col("to").alias("farther"))
        jump = materialize(jump.join(far.hint("merge"), ["file_key", "to"]).select("file_key", "at", F.col("farther").alias("to")))
    return reached


class _Plan:
    """What tasks must know of each split, in sorted arrays."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("file_key", "ascending"), ("split", "ascending")])
        self.columns = {c: table[c].fill_null(-1).to_numpy() for c in table.column_names}

    def of(self, key: int, split: int) -> tuple[int, ...] | None:
        """Base, where records begin, start and block and end of the record before (-1 for none); None for a split of another plan."""
        c = self.columns
        a, b = (np.searchsorted(c["file_key"], key, side) for side in ("left", "right"))
        i = a + np.searchsorted(c["split"][a:b], split)
        if i == b:
            return None
        return tuple(int(c[n][i]) for n in ("base", "enters", "carried", "carried_head", "carried_end"))


def _records_of(lines: DataFrame, plan: _Plan) -> DataFrame:
    """Pieces of the records of the splits in ``plan``: header of the first piece, block bytes."""
    shared = lines.sparkSession.sparkContext.broadcast(plan)

    def run(batches):
        for key, split, data in splits_of(batches):
            if (known := shared.value.of(key, split)) is None:
                continue
            base, enters, carried, carried_head, carried_end = known
            out = []
            if carried >= 0:  # bytes of a record that began before
                a, b = min(len(data), max(0, carried_head - base)), min(len(data), carried_end - base)
                out.append((carried, base, carried_end - carried_head, False, data[:a], data[a:b]))
            at, header = enters - base if enters >= 0 else len(data), _headers(data)
            while at < len(data):
                found = header(at)
                if not found:
                    break
                head, length = found
                block = data[at + head : min(at + head + length, len(data))]
                out.append((at + base, at + base, length, len(block) == length, data[at : at + head], block))
                at += head + length + 4
            if at < len(data):  # a header that goes on in the next split
                out.append((at + base, at + base, -1, False, data[at:], b""))
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(out), pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["file_key", "offset", "at", "length", "whole", "header", "block"])

    return lines.mapInArrow(run, "file_key long, offset long, at long, length long, whole boolean, header binary, block binary")


def _parsed(pieces: DataFrame) -> DataFrame:
    """Join the pieces of records that several splits hold, and take headers apart."""
    whole = pieces.filter("whole").select("file_key", "offset", "length", "header", "block")
    parts = pieces.filter("NOT whole").groupBy("file_key", "offset").agg(F.max("length").alias("length"), F.array_sort(F.collect_list(F.struct("at", "header", "block"))).alias("p"))
    joined = lambda name: F.aggregate("p", F.lit("").cast("binary"), lambda a, x: F.concat(a, F.coalesce(x[name], F.lit("").cast("binary"))))
    parts = parts.select("file_key", "offset", "length", joined("header").alias("header"), joined("block").alias("block")).filter(F.octet_length("block") == F.col("length"))
    rows = whole.union(parts).withColumn("h", F.col("header").cast("string"))
    value = lambda name: F.nullif(F.trim(F.regexp_extract("h", rf"(?im)^{name}:([^\r\n]*)", 1)), F.lit(""))
    rows = rows.select(
        "file_key", "offset", value("WARC-Type").alias("type"), value("WARC-Record-ID").alias("record_id"), value("WARC-Refers-To").alias("refers_to"),
        value("WARC-Target-URI").alias("uri"), value("WARC-Payload-Digest").alias("digest"), value("Content-Type").startswith("application/http").alias("http"), "block",
    )
    body = F.instr(F.col("block").cast("string"), "\r\n\r\n")  # HTTP headers are ASCII
    payload = F.when(F.col("http") & (body > 0), F.substring(F.col("block"), body + 4, F.octet_length("block"))).otherwise(F.col("block"))
    return rows.withColumn("payload", payload).drop("http", "block")


# Tables of records and splits grow with the archives: they are joined by shuffles, whatever their size.


def read_warc(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """All records of the uncompressed archives below ``path``.

    Returns ``file_key, offset, type, record_id, refers_to, uri, digest, payload``;
    the payload of an HTTP message is what follows its header. Bytes that no chain
    from a file's start reaches are not records. Headers and records may
    span any number of splits, but a record must fit a task. A file whose chain ends
    before the file does, or after it, as one that is cut off or damaged, is an error;
    with ``strict=False`` its records before that place are returned.
    """
    scan = materialize(scan_candidates(spark, path))
    summary = materialize(bases(scan.filter("kind = 0").select("file_key", "split", F.col("at").alias("n_bytes"), "edge")))
    where = summary.select("file_key", "split", "base")
    inside = scan.filter("kind = 1").join(where.hint("merge"), ["file_key", "split"]).select("file_key", "split", *[(F.col(c) + F.col("base")).alias(c) for c in ("at", "leave", "last", "body")])
    candidates = materialize(inside.union(_stitched(summary)))
    entries = reachable_entries(candidates.select("file_key", "at", "leave"))
    if strict:
        ends = candidates.join(entries.hint("merge"), ["file_key", "at"], "left_semi").groupBy("file_key").agg(F.max("leave").alias("end"))
        sizes = summary.groupBy("file_key").agg(F.sum("n_bytes").alias("size")).join(ends.hint("merge"), "file_key", "left")
        bad = sizes.filter("end IS NULL OR end <> size").join(file_sizes(spark, path).select("file_key", "path"), "file_key").select("path", "end").take(1)
        if bad:
            raise ValueError(f"the records of {bad[0].path} don't end with the file (last known end: byte {bad[0].end})")
    # Of each split the first reached record, and the record that covers its start.
    entered = candidates.join(entries.hint("merge"), ["file_key", "at"], "left_semi").groupBy("file_key", "split").agg(F.min("at").alias("enters"), F.max(F.struct("at", "leave", "last", "body")).alias("e"))
    before = Window.partitionBy("file_key").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    plan = summary.select("file_key", "split", "base").join(entered.hint("merge"), ["file_key", "split"], "left").withColumn("c", F.last("e", ignorenulls=True).over(before))
    covers = F.col("base") < F.col("c.leave") - 4
    plan = plan.select(
        "file_key", "split", "base", "enters",
        *[F.when(covers, x).alias(n) for n, x in (("carried", F.col("c.last")), ("carried_head", F.col("c.body")), ("carried_end", F.col("c.leave") - 4))],
    )
    plan, lines = materialize(plan), read_lines(spark, path)
    out, groups = None, max(1, -(-plan.count() // SPLITS_AT_ONCE))
    # One for all but very many splits. Each reads all files: the reader would cut a part of them into other splits.
    for g in range(groups):
        part = _records_of(lines, _Plan(plan.filter(F.pmod(F.col("file_key"), F.lit(groups)) == g).toArrow()))
        out = part if out is None else out.union(part)
    return _parsed(out)
